"""Staging and foundation: from report rows to facts and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse.functions import clock, text
from outpulse.functions.hashing import report_row_key
from outpulse.functions.money import parse_money
from outpulse.functions.numeric import num, ratio
from outpulse.operators.joins import absent_from, salted_lookup
from outpulse.operators.ranking import first_per_key, top_k

FEE_KEPT = 0.8


def price_tier(price, top: str | None = "premium") -> Column:
    p = num(price)
    tiers = F.when(p == 0, "free").when(p < 5, "low").when(p < 20, "medium")
    return tiers.when(p < 50, "high").otherwise(top) if top else tiers.otherwise("high")


def size_band(sent, top: str = "mega", top_from: int = 5000) -> Column:
    return (
        F.when(F.col(sent) < 100, "small")
        .when(F.col(sent) < 1000, "medium")
        .when(F.col(sent) < top_from, "large")
        .otherwise(top)
    )


def quality_label() -> Column:
    return (
        F.when(F.col("template").isNull(), "missing_template")
        .when(F.col("account").isNull(), "missing_account")
        .when(F.col("sent_at").isNull(), "missing_time")
        .when((F.col("sent") == 0) & ((F.col("viewed") > 0) | (F.col("purchased") > 0)), "zero_send_anomaly")
        .when(F.col("viewed") > F.col("sent"), "view_count_anomaly")
        .when((F.col("purchased") > F.col("viewed")) & (F.col("viewed") > 0), "purchase_count_anomaly")
        .when(F.col("earnings") > F.col("price") * F.col("sent"), "revenue_anomaly")
        .otherwise("clean")
    )


def labelled_sends(facts: DataFrame, as_of: str, days: int) -> DataFrame:
    """Repair implausible values and name the first quality rule a row breaks."""
    return (
        facts.where(clock.within_days("sent_at", as_of, days))
        .withColumn("quality", quality_label())
        .withColumn(
            "revenue",
            F.when(F.col("earnings") < 0, F.lit(0))
            .when(F.col("earnings") > F.col("price") * F.col("sent"), F.col("price") * F.col("purchased"))
            .otherwise(F.coalesce("earnings", F.lit(0)))
            .cast("decimal(18,2)"),
        )
        .withColumn("price", F.least(F.greatest(F.coalesce("price", F.lit(0)), F.lit(0)), F.lit(1000)).cast("decimal(18,2)"))
        .fillna(0, subset=["sent", "viewed", "purchased"])
    )


def staged_sends(facts: DataFrame, as_of: str, days: int = 180) -> DataFrame:
    """Recent, repaired, deduplicated sends with rates and tiers."""
    labelled = labelled_sends(facts, as_of, days)
    unique = first_per_key(
        labelled,
        ["message_id", "template", "account", "sent_at"],
        [F.col("quality"), F.col("revenue").desc(), F.col("sent").desc()],
    )
    return unique.where(
        F.col("quality").isin("clean", "view_count_anomaly")
        & (F.col("sent") > 0)
        & (F.col("sent_at") > F.expr("timestamp_ntz'1990-01-01 00:00:00'"))
    ).select(
        "message_id", "template", "account", "sent_at", "sent_date", "sent", "viewed", "purchased",
        "price", "revenue",
        ratio("viewed", "sent").alias("view_rate"),
        ratio("purchased", "sent").alias("purchase_rate"),
        ratio("revenue", "sent").alias("revenue_per_send"),
        F.hour("sent_at").alias("hour"),
        clock.sunday_based("sent_at").alias("weekday"),
        F.date_format("sent_at", "yyyy-MM").alias("year_month"),
        price_tier("price").alias("price_tier"),
        size_band("sent").alias("size_band"),
        "quality",
    )


def parsed_reports(reports: DataFrame) -> DataFrame:
    """Report text to typed columns; nothing is dropped here."""
    return reports.select(
        "run_id", "ingested_at", "ingestion_date", "message_id", "source_file", "sender",
        "sent", "viewed", "purchased", "message",
        report_row_key("message_id", "source_file", "sending_time", "message").alias("row_key"),
        text.strip_html("message").alias("clean_message"),
        text.file_account("source_file").alias("file_account"),
        clock.parse_report_time("sending_time").alias("sent_at"),
        parse_money("price").alias("price"),
        parse_money("earnings").alias("revenue"),
    )


def normalised_reports(reports: DataFrame, start: str, end: str) -> DataFrame:
    """Reports landed between two dates, cleaned and deduplicated by
    (text, sender, day); the latest send of a day stays."""
    window = reports.where(F.col("ingestion_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    typed = parsed_reports(window).withColumn(
        "template", F.sha2(F.lower("clean_message"), 256)
    ).withColumn("sent_date", F.to_date("sent_at"))
    unique = first_per_key(
        typed,
        ["template", "sender", "sent_date"],
        [F.col("sent_at").desc(), F.col("message_id").desc(), F.col("ingested_at").desc()],
    )
    return unique.select(
        F.sha2(F.concat_ws("|", "template", F.coalesce("sender", F.lit("null")), F.col("sent_date").cast("string")), 256).alias("send_key"),
        "template", "sender", F.col("file_account").alias("account"), "sent_at", "sent_date",
        "price", "revenue", "sent", "viewed", "purchased",
        ratio("viewed", "sent").alias("view_rate"),
        ratio("purchased", "sent").alias("purchase_rate"),
        ratio("purchased", "viewed").alias("purchase_given_view"),
        ratio("revenue", "sent").alias("revenue_per_send"),
        price_tier("price", top=None).alias("price_tier"),
        size_band("sent", "massive", 10000).alias("size_band"),
        "message_id", "run_id", "ingested_at",
    )


def split_message(reports: DataFrame) -> DataFrame:
    """'name: copy' messages into their two halves (tags removed first)."""
    typed = parsed_reports(reports)
    return typed.select(
        "*",
        F.nullif(F.trim(F.regexp_extract("clean_message", r"^([^:]+):", 1)), F.lit("")).alias("raw_name"),
        F.nullif(F.trim(F.regexp_extract("clean_message", r":\s*(.*)$", 1)), F.lit("")).alias("body"),
    )


def daily_deduplicated(messages: DataFrame) -> DataFrame:
    return first_per_key(
        messages.withColumn("sent_date", F.to_date("sent_at")),
        ["clean_message", "sender", "sent_date"],
        [F.col("sent_at").desc(), F.col("message_id").desc()],
    )


def transferred_sends(
    reports: DataFrame, names: DataFrame, library: DataFrame, as_of: str, days: int, tz: str
) -> DataFrame:
    """Deduplicated messages as fact rows: mapped name, library hash or md5 of
    the copy, platform fee taken off, calendar parts in the business zone."""
    m = daily_deduplicated(split_message(reports)).where(
        (F.col("sent") > 0) & clock.within_days("sent_at", as_of, days)
    )
    m = m.withColumn("name_key", F.lower(F.trim(F.coalesce("raw_name", "sender"))))
    m = m.withColumn("body_key", F.lower(F.trim("body")))
    mapped = salted_lookup(m, names.select(F.lower(F.trim("raw_name")).alias("name_key"), "standard_name"), ["name_key"])
    hashed = salted_lookup(
        mapped, library.select(F.lower(F.trim("body")).alias("body_key"), F.col("template").alias("known")), ["body_key"]
    )
    at = clock.local("sent_at", tz)
    return hashed.select(
        F.coalesce("standard_name", "name_key").alias("account_key"),
        F.coalesce("known", F.md5("body_key")).alias("template_key"),
        "sent_at", F.to_date(at).alias("sent_date"), F.hour("sent_at").alias("hour_utc"),
        F.dayofweek(at).alias("weekday"), F.weekofyear(at).alias("iso_week"), F.month(at).alias("month"),
        "sent", "viewed", "purchased", "price", "revenue",
        (num("revenue") * FEE_KEPT).alias("net_revenue"),
        ratio("viewed", "sent").alias("view_rate"),
        ratio("purchased", "viewed").alias("conversion_rate"),
        ratio("revenue", "sent").alias("revenue_per_send"),
        F.when((F.col("viewed") >= 0) & (F.col("purchased") >= 0), "valid").otherwise("check_required").alias("quality"),
    ).withColumn(
        "send_key",
        F.sha2(F.concat_ws("|", "account_key", "template_key", F.date_format("sent_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")), 256),
    )


# First match names the kind of a new template.
KIND_RULES = (
    ("ppv", "tip|ppv|pay|buy|purchase|exclusive|unlock"),
    ("promo", "sale|discount|offer|promo|deal|limited"),
    ("greeting", "hello|hi|hey|morning|night|welcome"),
    ("cta", "click|link|bio|check out|swipe"),
    ("free", "free|freebie|gift"),
    ("custom", "custom|personal|request"),
)
TAG_RULES = (
    ("monetization", "tip|ppv|pay"),
    ("promotion", "sale|discount|offer"),
    ("greeting", "hello|hi|hey"),
    ("hashtags", r"#\w+"),
    ("links", r"http|www\.|\.com|link\.bio"),
)


def classify_copy(body) -> list[Column]:
    """Kind, length class and tags of a piece of copy."""
    low = F.lower(F.col(body))
    kind = None
    for name, pattern in KIND_RULES:
        cond = low.rlike(pattern)
        kind = F.when(cond, name) if kind is None else kind.when(cond, name)
    n = F.length(body)
    tags = F.filter(
        F.array(*[F.when(low.rlike(p), F.lit(t)) for t, p in TAG_RULES]), lambda t: t.isNotNull()
    )
    return [
        kind.otherwise("general").alias("kind"),
        F.when(n < 50, "short").when(n < 150, "medium").when(n < 300, "long").otherwise("very_long").alias("length_class"),
        F.array_join(tags, ",").alias("tags"),
    ]


def new_templates(reports: DataFrame, library: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Copy seen in reports but missing from the library, classified."""
    m = daily_deduplicated(split_message(reports)).where(
        clock.within_days("sent_at", as_of, days) & F.col("raw_name").isNotNull() & (F.length("body") > 5)
    )
    seen = (
        m.groupBy("raw_name", "body")
        .agg(
            F.count(F.lit(1)).alias("uses"),
            F.max("sent_at").alias("last_used_at"),
            F.avg(num("price")).alias("avg_price"),
        )
        .withColumn("body_key", F.lower(F.trim("body")))
    )
    fresh = absent_from(seen, (library.select(F.lower(F.trim("body")).alias("body_key")), ["body_key"]))
    return fresh.select(
        F.md5("body_key").alias("template"), "raw_name", "body", "uses", "last_used_at", "avg_price",
        *classify_copy("body"),
    )


def name_mapping(reports: DataFrame, known: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Names seen in messages that the mapping does not have yet."""
    m = daily_deduplicated(split_message(reports)).where(
        clock.within_days("sent_at", as_of, days) & (F.length("raw_name") > 2)
    )
    totals = m.groupBy("raw_name").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("sent").alias("sent"),
        F.sum("revenue").cast("double").alias("revenue"), F.max("sent_at").alias("last_seen"),
    )
    fresh = absent_from(
        totals.withColumn("name_key", F.lower(F.trim("raw_name"))),
        (known.select(F.lower(F.trim("raw_name")).alias("name_key")), ["name_key"]),
    )
    low = F.lower("raw_name")
    return fresh.select(
        "raw_name",
        F.col("name_key").alias("normal_name"),
        F.regexp_replace(low, "[^a-z0-9]", "").alias("base_name"),
        F.regexp_replace(F.regexp_replace(low, "[^a-z0-9]", "_"), "_+", "_").alias("standard_name"),
        F.when(low.rlike("free|trial"), "free").when(low.rlike("vip|premium|paid"), "paid")
        .when(F.col("revenue") > 1000, "premium").when(F.col("revenue") > 100, "standard")
        .otherwise("basic").alias("account_type"),
        "messages", "sent", "revenue", "last_seen",
    )


# Fixed value: the end of a dimension row that is current.
OPEN_END = "9999-12-31 23:59:59"


def new_account_rows(mapping: DataFrame, dimension: DataFrame, as_of: str, source: str) -> DataFrame:
    """Dimension rows for mapped names whose account is not there yet, valid from ``as_of`` on.

    Names that lead to one account give one row, that of the name seen last (then the smaller name).
    """
    one = top_k(mapping, ["standard_name"], [F.col("last_seen").desc(), F.col("raw_name")], 1)
    fresh = absent_from(one, (dimension.select(F.col("account_key").alias("standard_name")), ["standard_name"]))
    return fresh.select(
        F.col("standard_name").alias("account_key"), F.col("standard_name").alias("account"), "account_type", F.lit("active").alias("status"),
        clock.day(as_of).alias("created_date"), F.to_date("last_seen").alias("last_active_date"), clock.moment(as_of).alias("valid_from"),
        F.lit(OPEN_END).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"), F.lit(source).alias("source"))


def template_dimension(templates: DataFrame, owners: DataFrame) -> DataFrame:
    """Current version of every template with tags and owner."""
    tags = F.array_sort(F.array_distinct(F.filter(
        F.regexp_extract_all(F.lower("body"), F.lit(r"#(\w+)"), F.lit(1)), lambda t: F.length(t) > 2
    )))
    low = F.lower("category")
    return templates.join(owners, "template", "left").select(
        "template", F.concat(F.lit("CAP_"), "template").alias("template_id"),
        F.when(low.like("%ppv%"), "ppv").when(low.like("%sub%"), "subscription")
        .when(low.like("%tip%"), "tip_menu").when(low.like("%free%"), "free")
        .otherwise(F.coalesce("category", F.lit("standard"))).alias("category"),
        tags.alias("tags"), F.size(tags).alias("tag_count"), F.length("body").alias("body_length"),
        text.content_level("body").alias("content_level"), "owner",
        F.lit(True).alias("is_current"),
    )


def account_dimension(accounts: DataFrame, facts: DataFrame, as_of: str) -> DataFrame:
    """Account attributes with a revenue segment over the last 90 days."""
    perf = facts.where(clock.within_days("sent_at", as_of, 90)).groupBy("account").agg(
        F.avg(num("earnings")).alias("avg_revenue"),
        F.stddev(num("earnings")).alias("revenue_volatility"),
        F.countDistinct("sent_date").alias("active_days"),
        F.max("sent_date").alias("last_active"),
    )
    age = clock.days_between(clock.day(as_of), "last_active")
    kinds = F.array(*[F.lit(k) for k in ("free", "main", "vip")])
    return (
        accounts.join(perf, "account", "left")
        .withColumn(
            "segment",
            F.when(F.col("avg_revenue") >= 100, "whale").when(F.col("avg_revenue") >= 10, "high_value")
            .when(F.col("avg_revenue") >= 1, "regular").when(F.col("avg_revenue") > 0, "casual")
            .otherwise("inactive"),
        )
        .select(
            "account", "display_name",
            F.when(F.col("segment") == "whale", "premium").when(F.col("segment") == "high_value", "vip")
            .otherwise("standard").alias("account_type"),
            F.struct(
                F.col("page_type").alias("primary"),
                F.array_except(kinds, F.array("page_type")).alias("secondary"),
            ).alias("page_types"),
            "segment", "avg_revenue", "revenue_volatility", "active_days",
            F.when(age <= 7, "active").when(age <= 30, "dormant").when(age <= 90, "at_risk")
            .otherwise("churned").alias("account_status"),
            "assignee", "last_active",
        )
    )


def send_fact(facts: DataFrame, accounts: DataFrame, templates: DataFrame) -> DataFrame:
    """One row per send with dimension keys, rates and a quality flag."""
    a = accounts.select("account", F.col("account").alias("account_key"))
    t = templates.select("template", F.col("template").alias("template_key"))
    joined = salted_lookup(salted_lookup(facts, a, ["account"]), t, ["template"])
    net = num("earnings") * FEE_KEPT
    return joined.select(
        "message_id", "account", "template",
        F.coalesce("template_key", F.lit("UNKNOWN")).alias("template_key"),
        F.coalesce("account_key", F.lit("UNKNOWN")).alias("account_key"),
        "sent_at", "sent_date", F.hour("sent_at").alias("hour"),
        clock.sunday_based("sent_at").alias("weekday"),
        clock.sunday_week("sent_at").alias("week"), F.month("sent_at").alias("month"),
        "sent", "viewed", "purchased", "price", "earnings", net.alias("net_revenue"),
        ratio("viewed", "sent").alias("view_rate"), ratio("purchased", "sent").alias("purchase_rate"),
        ratio("purchased", "viewed").alias("conversion_rate"),
        ratio(net, "sent").alias("revenue_per_send"),
        ratio(net, "purchased").alias("revenue_per_purchase"),
        ratio(F.col("sent") - F.col("viewed"), "sent").alias("bounce_rate"),
        F.when(F.col("sent") == 0, "zero_sends").when(F.col("viewed") > F.col("sent"), "view_anomaly")
        .when(F.col("purchased") > F.col("viewed"), "purchase_anomaly")
        .when(F.col("earnings") < 0, "negative_revenue").otherwise("valid").alias("quality"),
    )


def dm_send_facts(facts: DataFrame, accounts: DataFrame, as_of: str, days: int) -> DataFrame:
    """Valid sends of the last days in the account's own time."""
    ok = facts.where(
        clock.within_days("sent_at", as_of, days)
        & (F.col("sent") > 0) & (F.col("viewed") <= F.col("sent")) & (F.col("purchased") <= F.col("viewed"))
    )
    j = salted_lookup(ok, accounts.select("account", "account_page", "page_type", "tz", "is_paid"), ["account"], "inner")
    at = clock.local("sent_at", F.coalesce("tz", F.lit("UTC")))
    rps = ratio(num("earnings") * FEE_KEPT, "sent")
    return j.select(
        "message_id", "account", "account_page", "template", "sent_at", at.alias("local_at"),
        clock.monday_based(at).alias("dow"), F.hour(at).alias("hod"),
        F.when(num("price") > 0, "paid").otherwise("free").alias("kind"),
        "price", "sent", "viewed", "purchased", "earnings",
        ratio("viewed", "sent").alias("open_rate"), ratio("purchased", "sent").alias("buy_rate"),
        ratio("purchased", "viewed").alias("buy_rate_viewed"), rps.alias("rps"),
        ratio("earnings", "purchased").alias("revenue_per_buyer"),
    )


def local_sends(facts: DataFrame, accounts: DataFrame, as_of: str, days: int = 180) -> DataFrame:
    """Sends of active accounts with local calendar parts and log measures."""
    active = accounts.where("is_active").select("account", "tz")
    j = salted_lookup(facts.where(clock.within_days("sent_at", as_of, days)), active, ["account"], "inner")
    at = clock.local("sent_at", F.col("tz"))
    return j.select(
        "message_id", "account", "template", at.alias("local_at"), F.to_date(at).alias("local_date"),
        clock.monday_based(at).alias("dow"), F.hour(at).alias("hod"), "price", "earnings", "sent",
        F.ln(num("price")).alias("log_price"), ratio("earnings", "sent").alias("rps"),
    )


def sends_by_page(facts: DataFrame, accounts: DataFrame, as_of: str, days: int | None = None) -> DataFrame:
    """Sends under their account page; the date guard is a plain comparison on
    the partition column, so only the needed days are scanned."""
    f = facts if days is None else facts.where(clock.day_within("sent_date", as_of, days))
    pages = accounts.select("account", F.concat_ws("__", "account", F.coalesce("page_type", F.lit("main"))).alias("account_page"))
    return salted_lookup(f, pages, ["account"]).withColumn("account_page", F.coalesce("account_page", F.concat("account", F.lit("__main"))))


def active_accounts(dimension: DataFrame, as_of: str, overrides: DataFrame, days: int = 21) -> DataFrame:
    """Accounts seen lately, with the page, paid status and assignee in force."""
    live = dimension.where((F.col("account_status") == "active") & (F.col("last_active") >= F.date_sub(clock.day(as_of), days)))
    j = live.join(overrides.select("account", F.col("assignee").alias("forced")), "account", "left")
    page = F.col("page_types.primary")
    return j.select(
        "account", page.alias("page_type"), F.concat_ws("__", F.col("account"), page).alias("account_page"), (page != "free").alias("is_paid"),
        F.coalesce("forced", "assignee", F.lit("unassigned")).alias("assignee"), F.col("segment").alias("tier"), "last_active",
    )


def account_state(facts: DataFrame, accounts: DataFrame, as_of: str) -> DataFrame:
    """Planning state with the revenue of the last 7 and 28 days."""
    week = clock.within_days("sent_at", as_of, 7)
    r = facts.where(clock.within_days("sent_at", as_of, 28)).groupBy("account").agg(
        F.sum(F.when(week, F.col("earnings"))).alias("r7"), F.sum("earnings").alias("r28"))
    return accounts.select("account", "page_state").join(r, "account", "left").select(
        "account", "page_state", F.coalesce(num("r7"), F.lit(0.0)).alias("revenue_7d"), F.coalesce(num("r28"), F.lit(0.0)).alias("revenue_28d"))


def kind_pivot(facts: DataFrame) -> DataFrame:
    """Sends and revenue per account, one pair of columns per price tier."""
    tiers = ["free", "low", "medium", "high", "premium"]
    keyed = facts.withColumn("tier", price_tier("price"))
    return keyed.groupBy("account").pivot("tier", tiers).agg(F.count(F.lit(1)).alias("sends"), F.sum("earnings").cast("double").alias("revenue"))
