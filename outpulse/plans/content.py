"""Message-copy library upkeep, content rules, name mapping and settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from outpulse.functions import clock, text
from outpulse.functions.numeric import num, ratio
from outpulse.operators.joins import absent_from, group_stats, salted_lookup
from outpulse.operators.matching import best_similar
from outpulse.operators.ranking import first_per_key, top_k
from outpulse.operators.upsert import added_only
from outpulse.plans.ingest import parsed_reports


def backfill(reports: DataFrame, names: DataFrame, active: DataFrame) -> DataFrame:
    """Historical rows of active accounts under their mapped names."""
    typed = parsed_reports(reports).withColumn("raw_name", F.lower(F.trim(F.regexp_extract("clean_message", r"^([^:]+):", 1))))
    mapped = typed.join(names.select(F.lower("raw_name").alias("raw_name"), "standard_name"), "raw_name", "left").withColumn(
        "account", F.coalesce("standard_name", F.translate("raw_name", "_", " "))
    )
    return mapped.where(F.col("sent_at").isNotNull() & (F.col("revenue") >= 0)).join(active.select("account"), "account", "left_semi")


def backfill_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("account").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("revenue").alias("revenue"), F.min("sent_at").alias("first_at"), F.max("sent_at").alias("last_at"))


def quarantine(reports: DataFrame, first_year: int, last_year: int) -> tuple[DataFrame, DataFrame]:
    """(rows to migrate, rows set aside as JSON with the reason)."""
    at = clock.parse_report_time("sending_time")
    rows = reports.withColumn("parsed_at", at)
    ok = F.coalesce(F.year("parsed_at").between(first_year, last_year), F.lit(False))
    bad = rows.where(~ok).select(
        F.coalesce("message_id", F.lit("unknown")).alias("message_id"), F.lit("implausible_year_or_unparsable").alias("reason"),
        F.to_json(F.struct("message", "sending_time", "sender", "price", "sent", "viewed", "purchased", "earnings")).alias("raw_data"),
        F.concat(F.lit("cannot use time: "), F.coalesce("sending_time", F.lit("NULL"))).alias("details"),
    )
    return rows.where(ok), bad


def refusal(min_chars: int = 3, max_chars: int | None = None) -> Column:
    """Why a text is not taken, NULL where it is."""
    n = F.length(F.trim("body"))
    return (
        F.when(F.col("body").isNull(), "no text").when(n < min_chars, "too short").when(n > max_chars if max_chars is not None else F.lit(False), "too long")
        .when(F.col("body").contains("�"), "damaged text")
    )


def refused_templates(sources: DataFrame, min_chars: int = 3, max_chars: int | None = None) -> DataFrame:
    """The rows the inflow does not take, with the reason."""
    return sources.withColumn("reason", refusal(min_chars, max_chars)).where(F.col("reason").isNotNull())


def template_inflow(sources: DataFrame, bank: DataFrame, min_chars: int = 3, max_chars: int | None = None) -> DataFrame:
    """New copy from prioritised sources: best source per canonical text, size
    and damage guards, and not in the bank under either hash."""
    s = sources.where(refusal(min_chars, max_chars).isNull()).withColumns({
        "hash_v1": F.md5(F.lower(F.trim("body"))), "hash_v2": text.canonical_hash("body")})
    best = first_per_key(s, ["hash_v2"], [F.col("priority"), F.col("source_id")])
    fresh = absent_from(best, (bank, ["hash_v1"]), (bank, ["hash_v2"]))
    return fresh.select(
        "source_id", "body", "priority", "hash_v1", "hash_v2", text.length_bin("body").alias("length_bin"), text.emoji_bin("body").alias("emoji_bin"),
        text.has_cta("body").alias("has_cta"), text.has_urgency("body").alias("has_urgency"), text.ends_with_question("body").alias("ends_with_question"))


def bank_rows(inflow: DataFrame) -> DataFrame:
    """Inflow as library rows, insert only."""
    return inflow.select(
        F.concat(F.lit("CAP_"), F.substring("hash_v2", 1, 16)).alias("template_id"), "hash_v1", "hash_v2", "body", F.lit("main").alias("kind"),
        text.content_level("body").alias("content_level"), text.theme_tags("body").alias("theme_tags"), F.col("length_bin").alias("length_class"),
        F.lit(0).cast("long").alias("times_used"))


def update_bank(spark: SparkSession, inflow: DataFrame, bank_path: str, log_path: str, run_id: str, run_at: str) -> dict:
    """Append new rows to the bank and log the run; a failure is logged whole,
    then raised again.  A repeated run finds its rows there and adds none.

    Source and new rows are counted while they pass to the writer, not by jobs of their own.
    """
    error, added, seen = None, 0, 0
    try:
        source, new = Observation(), Observation()
        rows = bank_rows(inflow).observe(source, F.count(F.lit(1)).alias("rows"))
        target = spark._jvm.org.apache.hadoop.fs.Path(bank_path)
        if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
            old = spark.read.schema(rows.schema).parquet(bank_path)
            rows = added_only(old, rows, ["hash_v2"], [F.col("template_id")])
        rows.observe(new, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(bank_path)
        seen, added = source.get["rows"], new.get["rows"]
        return {"source_rows": seen, "inserted": added}
    except Exception as exc:
        error = str(exc)
        raise
    finally:
        spark.createDataFrame(
            [(run_id, run_at, seen, added, seen - added, 0 if error is None else 1, error)],
            "run_id string, run_at string, source_rows long, inserted long, duplicates long, errors int, error_sample string",
        ).write.mode("append").parquet(log_path)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    reason: str
    pattern: str
    family: str = ""


# Site rules are data; these defaults cover abuse, coercion and leaked details.
DEFAULT_RULES = (
    Rule("A1_insult", "abusive language", r"(^|[^a-z])(worthless|pathetic|stupid|idiot)($|[^a-z])", "abuse"),
    Rule("A2_threat", "threatening language", r"(^|[^a-z])(kill you|hurt you)($|[^a-z])", "abuse"),
    Rule("B1_coercion", "coercion", r"(^|[^a-z])(blackmail|forced|against your will)($|[^a-z])"),
    Rule("C1_contact", "e-mail address", r"[a-z0-9._-]+@[a-z0-9-]+\.[a-z]{2,}"),
    Rule("C2_link", "plain link", r"https?://"),
)
ALLOW_PATTERN, ALLOW_FAMILY = r"(^|[^a-z])(quote|quoted)($|[^a-z])", "abuse"


def rule_hits(body: str, rules=DEFAULT_RULES) -> Column:
    """Ids of the rules a text breaks; the allow-list lifts one family."""
    low = F.lower(F.coalesce(F.col(body), F.lit("")))
    allowed = low.rlike(ALLOW_PATTERN)
    tests = [F.when(low.rlike(r.pattern) & (~allowed if r.family == ALLOW_FAMILY else F.lit(True)), F.lit(r.rule_id)) for r in rules]
    return F.filter(F.array(*tests), lambda x: x.isNotNull())


def classify_by_price(body: str, price: str) -> Column:
    """Price first, then links, then tips."""
    low = F.lower(F.coalesce(F.col(body), F.lit("")))
    return (
        F.when(F.col(price) > 0, "paid_message").when(low.rlike("https://.*renew") | (low.contains("https://") & low.rlike("renew(al)?")), "renewal")
        .when(low.contains("https://"), "link_drop").when(low.rlike(r"tip (me|for|to|if|\$)|send (a )?tip|\$\d+ tip"), "tip_request").otherwise("bump")
    )


def content_audit(rows: DataFrame) -> DataFrame:
    """Every text once (first row wins), its rule hits and its class."""
    unique = first_per_key(rows.withColumn("_h", F.sha2(F.trim("body"), 256)), ["_h"], [F.col("doc_id")]).drop("_h")
    return unique.select("doc_id", "price", rule_hits("body").alias("hits"), classify_by_price("body", "price").alias("category"),
                         F.lower("body").rlike("renew(al)?").alias("mentions_renewal"), F.lower("body").contains("https://").alias("has_link"))


def audit_counts(audit: DataFrame) -> DataFrame:
    c = audit.groupBy("category").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.size("hits") > 0).alias("violations"))
    total = audit.agg(F.count(F.lit(1)).alias("n")).scalar()
    return c.withColumn("percent", 100 * F.col("rows") / total)


def duplicate_rows(rows: DataFrame, key: Column) -> DataFrame:
    """All rows whose key occurs more than once."""
    keyed = rows.withColumn("_k", key)
    return group_stats(keyed, ["_k"], copies=F.count(F.lit(1))).where(F.col("copies") > 1).drop("_k")


def repaired_placeholders(rows: DataFrame, placeholder: str) -> DataFrame:
    """Drop the parentheses around a placeholder, and say which rows changed."""
    wrapped = f"({placeholder})"
    return rows.withColumns({"fixed": F.replace("body", F.lit(wrapped), F.lit(placeholder)), "changed": F.coalesce(F.col("body").contains(wrapped), F.lit(False))})


def mapped_names(seen: DataFrame, mapping: DataFrame, known: DataFrame) -> DataFrame:
    """Direct mappings, then the closest known name, else unmapped."""
    direct = seen.join(mapping.select("raw_name", "standard_name"), "raw_name").select("raw_name", "standard_name", F.lit("direct").alias("method"), F.lit(1.0).alias("confidence"))
    rest = seen.join(mapping.select("raw_name"), "raw_name", "left_anti").withColumn("_n", text.strip_kind("raw_name"))
    near = best_similar(rest, known.select(text.strip_kind("name").alias("_k")), "_n", "_k")
    fuzzy = rest.join(near, "_n", "left").select(
        "raw_name", F.col("_k").alias("standard_name"), F.when(F.col("_k").isNotNull(), "fuzzy").otherwise("unmapped").alias("method"), F.coalesce("score", F.lit(0.0)).alias("confidence"))
    return direct.unionByName(fuzzy)


def mapping_coverage(mapped: DataFrame) -> DataFrame:
    return mapped.groupBy("method").agg(F.count(F.lit(1)).alias("names"), F.avg("confidence").alias("avg_confidence"))


def mapped_by_first_name(seen: DataFrame, mapping: DataFrame) -> DataFrame:
    """Exact name without its kind, else the only account with that first
    name, else the cleaned name itself."""
    m = mapping.select(text.strip_kind("raw_name").alias("key"), "standard_name")
    exact = m.groupBy("key").agg(F.min("standard_name").alias("exact"))
    first = m.groupBy(F.substring_index("key", " ", 1).alias("first")).agg(
        F.min("standard_name").alias("by_first"), F.countDistinct("standard_name").alias("n")).where(F.col("n") == 1)
    s = seen.withColumn("key", text.strip_kind("raw_name")).withColumn("first", F.substring_index("key", " ", 1))
    j = s.join(exact, "key", "left").join(first.select("first", "by_first"), "first", "left")
    return j.select("raw_name", F.coalesce("exact", "by_first", "key").alias("account"),
                    F.when(F.col("exact").isNotNull(), "exact").when(F.col("by_first").isNotNull(), "first_name").otherwise("fallback").alias("method"))


def cleaned_overrides(overrides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Newest override per account, and the counts before and after."""
    kept = first_per_key(overrides, ["account"], [F.col("updated_at").desc_nulls_last(), F.col("note")])
    before = overrides.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("account").alias("accounts")).withColumn("stage", F.lit("before"))
    after = kept.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("account").alias("accounts")).withColumn("stage", F.lit("after"))
    return kept, before.unionByName(after)


def settings_row(settings: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Key/value settings pivoted to one typed row; defaults where absent."""
    return settings.agg(*[
        F.coalesce(F.max(F.when(F.col("setting_key") == k, F.col("setting_val"))), F.lit(default)).try_cast("double").alias(k) for k, default in keys.items()
    ])


def active_configuration(parameters: DataFrame, as_of: str, environment: str = "prod") -> DataFrame:
    """Active JSON configuration documents as columns."""
    live = parameters.where("is_active").where(
        (F.col("environment") == environment) & (F.col("expires_at").isNull() | (F.col("expires_at") > clock.moment(as_of))))

    def at(path: str) -> Column:
        return F.get_json_object("parameters", f"$.{path}").cast("double")

    return live.select(
        "config_id", "page_state", *[at(f"weights.{w}").alias(f"w_{w}") for w in ("performance", "exploration", "recency", "stability")],
        at("exploration.epsilon_percent").alias("epsilon_percent"), at("exploration.ucb_c").alias("ucb_c"),
        at("cooldown.min_hours").alias("min_cooldown_hours"), at("cooldown.fatigue_threshold").alias("fatigue_limit"))


def override_feedback(overrides: DataFrame, sends: DataFrame, projections: DataFrame) -> DataFrame:
    """What the overriding template earned that day against the projection of
    the one it replaced."""
    actual = sends.groupBy("account", "template", F.col("sent_date").alias("day")).agg(
        F.sum("earnings").cast("double").alias("revenue"), ratio(F.sum("viewed"), F.sum("sent")).alias("open_rate"))
    j = salted_lookup(overrides, actual.withColumnRenamed("template", "new_template"), ["account", "new_template", "day"], "inner")
    j = salted_lookup(j, projections.select("account", F.col("template").alias("old_template"), "projected"), ["account", "old_template"], "inner")
    return j.select(
        "override_id", "assignee", "account", "revenue", "projected", (F.col("revenue") - F.col("projected")).alias("delta"),
        F.when(F.col("revenue") > F.col("projected") * 1.1, "SUCCESS").when(F.col("revenue") < F.col("projected") * 0.9, "FAILURE").otherwise("NEUTRAL").alias("result"))


def override_accuracy(feedback: DataFrame) -> DataFrame:
    return feedback.groupBy("assignee").agg(
        F.count(F.lit(1)).alias("overrides"), F.count_if(F.col("result") == "SUCCESS").alias("successes"), F.count_if(F.col("result") == "FAILURE").alias("failures"),
        F.avg("delta").alias("avg_delta"), F.sum("delta").alias("total_delta"),
        F.count_if(F.col("delta") > 10).alias("high_value"), F.count_if(F.col("delta") < -10).alias("high_cost"),
    ).withColumn("accuracy", ratio("successes", "overrides"))


def open_rate_changes(overrides: DataFrame, sends: DataFrame) -> DataFrame:
    """Open rate of the overriding template that day less that of the one it replaced over all its sends on the account."""
    def opened(*keys: str) -> DataFrame:
        return sends.groupBy("account", "template", *keys).agg(ratio(F.sum("viewed"), F.sum("sent")).alias("rate"))

    now = opened("sent_date").withColumnsRenamed({"template": "new_template", "sent_date": "day", "rate": "new_rate"})
    before = opened().withColumnsRenamed({"template": "old_template", "rate": "old_rate"})
    j = salted_lookup(overrides.select("override_id", "account", "new_template", "old_template", "day"), now, ["account", "new_template", "day"])
    j = salted_lookup(j, before, ["account", "old_template"])
    return j.select("override_id", (F.col("new_rate") - F.col("old_rate")).alias("open_rate_delta"))


def override_training(overrides: DataFrame, feedback: DataFrame, changes: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Every override of the last ``days`` with its outcome, where it is known, how often its assignee was
    right over all overrides, and how much there is to learn from it."""
    j = overrides.select("override_id", "assignee", "account", "day").join(feedback.select("override_id", "result", "delta"), "override_id", "left").join(changes, "override_id", "left")
    known = j.groupBy("assignee").agg(F.count(F.lit(1)).alias("total_overrides"), F.count_if(F.col("result") == "SUCCESS").alias("successful"))
    j = salted_lookup(j.where(clock.day_within("day", as_of, days)), known, ["assignee"])
    priority = F.when(F.col("delta") > 10, "HIGH_VALUE_LEARNING").when(F.col("delta") < -10, "HIGH_COST_MISTAKE").otherwise("STANDARD_SIGNAL")
    return j.withColumns({"assignee_accuracy": ratio("successful", "total_overrides"), "training_priority": priority})


def override_impacts(feedback: DataFrame, top: int = 5) -> DataFrame:
    """Outcomes per assignee, with the ``top`` of the largest effect, a tie going to the smaller id."""
    per = feedback.groupBy("assignee").agg(
        F.count(F.lit(1)).alias("overrides"), F.count_if(F.col("result") == "SUCCESS").alias("successes"), F.count_if(F.col("result") == "FAILURE").alias("failures"),
        F.avg("delta").alias("avg_impact"), F.sum("delta").alias("total_impact")).withColumn("success_pct", 100 * ratio("successes", "overrides"))
    sized = feedback.withColumn("size", F.round(F.abs("delta"), 6))
    best = top_k(sized, ["assignee"], [F.col("size").desc(), F.col("override_id")], top).groupBy("assignee").agg(
        F.sort_array(F.collect_list(F.struct("rank", "account", "result", "delta"))).alias("impacts"))  # ``top`` rows each
    return per.join(best, "assignee", "left")


def ingestion_monitor(log: DataFrame) -> DataFrame:
    """Runs, inserted rows, duplicates and errors per day of the run log."""
    return log.groupBy(F.to_date("run_at").alias("run_date")).agg(
        F.count(F.lit(1)).alias("runs"), F.sum("inserted").alias("inserted"), F.max("inserted").alias("max_inserted"), F.sum("duplicates").alias("duplicates"),
        F.sum("errors").alias("errors"), F.min("error_sample").alias("error_sample"), ratio(F.sum("inserted"), F.sum("source_rows")).alias("insertion_rate"))
