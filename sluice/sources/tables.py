"""Table loaders and the mapping of the driver tables onto the lakehouse shapes.

Every mapping is a pure function of DataFrames (no reads inside), so Catalyst sees one
plan from the parquet scans to the final operator and can prune columns and push
filters into the scans. ``Tables`` is the only place that touches storage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import sized_broadcast

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

NL = "\n"


def _padded(prefix: str, col, width: int):
    return F.concat(F.lit(prefix), F.lpad(col.cast("string"), width, "0"))


# --- mappings --------------------------------------------------------------------
def dim_store(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """store = supplier; route = region of the supplier's nation."""
    geo = nation.join(sized_broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    supp = supplier.select("s_suppkey", "s_name", "s_nationkey")
    dim = supp.join(
        sized_broadcast(geo, basis=nation), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        _padded("S", F.col("s_suppkey"), 5).alias("store_id"),
        _padded("R", F.col("r_regionkey") + 1, 2).alias("route_id"),
        F.col("r_name").alias("route_name"),
        F.col("s_name").alias("store_name"),
    )
    # one row per supplier (nation and region joins are many-to-one): the supplier scan bounds it
    return sized_broadcast(dim, basis=supp)


def fact_sales(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """One sale per line item; returns (flag R) carry negative quantity and amount."""
    is_ret = F.col("l_returnflag") == "R"
    parts = sized_broadcast(part.select("p_partkey", "p_brand", "p_name", "p_retailprice"))
    return lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        _padded("S", F.col("l_suppkey"), 5).alias("store_id"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("sku"),
        F.when(is_ret, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int").alias("quantity"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("unit_price"),
        F.when(is_ret, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
        .cast("decimal(18,2)").alias("amount"),
        (F.col("l_linestatus") == "O").alias("is_active"),
        F.col("l_shipdate").cast("date").alias("sale_date"),
    )


def gold_pricing(lineitem: DataFrame, part: DataFrame, supplier: DataFrame,
                 nation: DataFrame, region: DataFrame) -> DataFrame:
    geo = nation.join(sized_broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    supp_scan = supplier.select("s_suppkey", "s_nationkey")
    supp = supp_scan.join(sized_broadcast(geo, basis=nation), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "n_nationkey", "n_name", "r_name")
    parts = sized_broadcast(part.select("p_partkey", "p_retailprice"))
    base = F.col("p_retailprice").cast("decimal(18,2)")
    return (
        lineitem.select("l_partkey", "l_suppkey")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(sized_broadcast(supp, basis=supp_scan), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            _padded("N", F.col("n_nationkey"), 2).alias("route_id"),
            F.col("n_name").alias("route_name"),
            F.lower(F.col("r_name")).alias("region"),
            F.col("p_partkey").alias("item_id"),
            base.alias("base_price"),
            (base * F.lit(1.05).cast("decimal(3,2)")).cast("decimal(18,4)").alias("adjusted_price"),
        )
    )


def seasonal_baseline(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_type").alias("season"),
        F.col("p_partkey").alias("item_id"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("base_price"),
    )


def pricing_baseline(part: DataFrame) -> DataFrame:
    return seasonal_baseline(part).drop("season")


def payload_log(events: DataFrame) -> DataFrame:
    """Inference payload log: one request per event."""
    return events.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").alias("request_time"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("requester"),
        F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        F.round(F.col("value") * 100, 0).cast("bigint").alias("execution_duration_ms"),
        F.col("props").alias("request"),
        F.concat(F.col("event_type"), F.lit(":"), F.col("props")).alias("response"),
    )


def payload_bursts(events: DataFrame, factor: int = 1440, users: int = 10) -> DataFrame:
    """The payload log with time running ``factor`` times faster and few users: minutes pass the real rate limits."""
    fast = F.timestamp_micros(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / factor)).cast("timestamp_ntz")
    return payload_log(events.withColumn("ts", fast).withColumn("user_id", F.col("user_id") % users))


def training_runs(events: DataFrame) -> DataFrame:
    """Training runs: one run per event, env from the user, MAE from the value; some lack the metric or a
    configuration key, some raise the threshold or change the features."""
    env = F.when(F.col("user_id") % 3 == 0, "dev").when(F.col("user_id") % 3 == 1, "staging").otherwise("prod")
    return events.select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("model_name"),
        env.alias("env"),
        F.col("ts").alias("start_time"),
        F.when(F.col("event_id") % 17 != 0, F.col("value")).alias("mae"),
        (F.lit(100.0) + 5 * (F.col("event_id") % 5 == 0).cast("int")).alias("max_acceptable_mae"),
        F.when(F.col("event_id") % 13 != 0, F.lit(50) + F.lit(25) * (F.col("event_id") % 3)).cast("int").alias("n_estimators"),
        F.when(F.col("event_id") % 7 != 0, "day_of_week,store_id").when(F.col("event_id") % 2 == 0, "day_of_week").alias("features"),
        (F.lit(4) + F.col("event_id") % 5).cast("int").alias("max_depth"),
        F.get_json_object("props", "$.k").cast("int").alias("min_samples_leaf"),
    )


# Lines that some changed files end with, by ``doc_id % 13``, so that every policy rule meets its case.
ADDED = {
    0: "rows = df.collect()", 1: "SELECT * FROM sales", 2: "SELECT store FROM sales ORDER BY 2", 3: "source = mlops_prod.sales",
    4: "CREATE TABLE dailySales (id INT)", 5: 'catalog: "main_prod"', 6: 'home = os.environ["HOME"]', 7: "SELECT * FROM sales" + NL,
    8: "-- note" + NL, 9: 'password = "correct-horse-battery"',
}
REPEATED = {7: 60, 8: 230}


def change_files(documents: DataFrame) -> DataFrame:
    """One changed file per document: its path, its text, and the diff of it.

    Most are added whole; ``doc_id % 6`` makes some changes of two hunks with kept and
    dropped lines and some renames, ``doc_id % 12`` makes some binary.
    """
    d = F.col("doc_id")
    ext = F.when(d % 4 == 0, ".py").when(d % 4 == 1, ".sql").when(d % 4 == 2, ".yml").otherwise(".md")
    tail = F.lit("")
    for k, line in ADDED.items():
        tail = F.when(d % 13 == k, F.repeat(F.lit(NL + line if k not in REPEATED else line), F.lit(REPEATED.get(k, 1)))).otherwise(tail)
    staged = documents.select(
        "doc_id", F.floor(d / 5).cast("bigint").alias("change_id"),
        F.concat(F.lit("src/"), F.col("source"), F.lit("/d"), d.cast("string"), ext).alias("path"),
        F.concat(F.col("text"), tail).alias("text"))
    n_lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit(NL), F.lit(""))) + 1
    added = F.concat(F.lit("+"), F.replace(F.col("text"), F.lit(NL), F.lit(NL + "+")))
    whole = F.concat(F.lit("@@ -0,0 +1,"), n_lines.cast("string"), F.lit(" @@" + NL), added)
    two = F.concat(F.lit("@@ -20,2 +20,"), (n_lines + 1).cast("string"), F.lit(" @@" + NL + " kept line" + NL + "-dropped line" + NL), added,
                   F.lit(NL + "@@ -500 +900,3 @@" + NL + "+tail one" + NL + " kept" + NL + "+tail two"))
    path, plus = F.col("path"), F.concat(F.lit(NL + "+++ b/"), F.col("path"), F.lit(NL))
    body = (F.when(d % 6 == 1, F.concat(plus, two))
            .when(d % 6 == 2, F.concat(F.lit(NL + "rename from old/"), path, F.lit(NL + "rename to "), path, plus, whole))
            .when(d % 12 == 3, F.concat(F.lit(NL + "Binary files a/"), path, F.lit(" and b/"), path, F.lit(" differ")))
            .otherwise(F.concat(plus, whole)))
    return staged.select("doc_id", "change_id", "path", "text",
                         F.concat(F.lit("diff --git a/"), path, F.lit(" b/"), path, body).alias("file_diff"))


def changes(documents: DataFrame) -> DataFrame:
    """One unified diff per change: its files in ``doc_id`` order.

    A change holds five documents by construction (``doc_id / 5``), so each group is
    bounded by five rows; the files are ordered inside the group by ``array_sort``.
    """
    return change_files(documents).groupBy("change_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "file_diff"))), lambda s: s["file_diff"]), NL).alias("diff"))


def model_responses(labels: DataFrame) -> DataFrame:
    """Stored promotion-gate responses in nine shapes: clean, fenced, in prose, cut, junk, bad enum, a key
    twice, a decision with a line end, and cut behind a backslash."""
    j = F.concat(
        F.lit('{"decision": "'),
        F.when(F.col("quality") == 1, "approve").otherwise("BLOCK"),
        F.lit('", "findings": [{"rule_id": "ML-03", "severity": "blocker", "message": "doc '),
        F.col("doc_id").cast("string"),
        F.lit('"}], "justification": "generated text"}'),
    )
    k = F.col("doc_id") % 9
    raw = (
        F.when(k == 0, j)
        .when(k == 1, F.concat(F.lit("```json" + NL), j, F.lit(NL + "```")))
        .when(k == 2, F.concat(F.lit("Decision follows: "), j, F.lit(" done {")))
        .when(k == 3, F.substring(j, F.lit(1), F.length(j) - 12))
        .when(k == 4, F.lit("no json here"))
        .when(k == 5, F.replace(j, F.lit('"decision": "'), F.lit('"decision": "X')))
        .when(k == 6, F.concat(F.lit('{"decision": "BLOCK", '), F.substring(j, F.lit(2), F.length(j))))
        .when(k == 7, F.replace(j, F.lit('", "findings"'), F.lit('\\n", "findings"')))
        .otherwise(F.concat(F.substring(j, F.lit(1), F.length(j) - 2), F.lit("\\")))
    )
    return labels.select(
        F.col("doc_id").alias("response_id"),
        F.when(F.col("quality") == 1, "APPROVE").otherwise("BLOCK").alias("truth"),
        raw.alias("raw"),
    )


def rule_docs(documents: DataFrame) -> DataFrame:
    """Handbook-style rule documents: a rule heading and fields over every document's text."""
    sev = F.when(F.col("doc_id") % 3 == 0, "BLOCKER").when(F.col("doc_id") % 3 == 1, "SUGGESTION").otherwise("STYLE")
    return documents.select(
        F.col("lang").alias("category"),
        "doc_id",
        F.concat(
            F.lit("### ["), F.upper("lang"), F.lit("-"), F.col("doc_id").cast("string"), F.lit("] Title "),
            F.col("doc_id").cast("string"), F.lit(NL + "- **Severity:** "), sev,
            F.lit(NL + "- **Citation:** Rules > "), F.col("lang"), F.lit(NL + NL), F.col("text"),
        ).alias("block"),
    )


def handbook(benchmark: DataFrame) -> DataFrame:
    """Handbook documents: one rule per benchmark item; every fifth has no fields, every seventh no title."""
    i = F.col("item_id")
    sev = F.when(i % 3 == 0, "BLOCKER").when(i % 3 == 1, "SUGGESTION").otherwise("STYLE")
    title = F.when(i % 7 == 6, F.lit("")).otherwise(F.concat(F.lit(" Item "), i.cast("string")))
    fields = F.when(i % 5 == 4, F.lit("")).otherwise(F.concat(F.lit("- **Severity:** "), sev, F.lit(NL + "- **Citation:** Items > "), i.cast("string"), F.lit(NL)))
    return benchmark.select(F.lit("Items").alias("category"), i.alias("doc_id"), F.concat(
        F.lit("### [IT-"), i.cast("string"), F.lit("]"), title, F.lit(NL), fields, F.lit(NL), F.col("text")).alias("block"))


# --- loader --------------------------------------------------------------------------
class Tables:
    """Lazy access to the driver's parquet tables and the mapped lakehouse tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._scans: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        """The table's scan; listed anew by every loader, so files that landed since are seen."""
        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._scans[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.read(name)
        raise AttributeError(name)

    @cached_property
    def dim_store(self) -> DataFrame:
        return dim_store(self.read("supplier"), self.read("nation"), self.read("region"))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return fact_sales(self.read("lineitem"), self.read("part"))

    @cached_property
    def gold_pricing(self) -> DataFrame:
        return gold_pricing(self.read("lineitem"), self.read("part"), self.read("supplier"),
                            self.read("nation"), self.read("region"))

    @cached_property
    def seasonal_baseline(self) -> DataFrame:
        return seasonal_baseline(self.read("part"))

    @cached_property
    def pricing_baseline(self) -> DataFrame:
        return pricing_baseline(self.read("part"))

    @cached_property
    def payload(self) -> DataFrame:
        return payload_log(self.read("events"))

    @cached_property
    def runs(self) -> DataFrame:
        return training_runs(self.read("events"))

    @cached_property
    def change_files(self) -> DataFrame:
        return change_files(self.read("documents"))

    @cached_property
    def changes(self) -> DataFrame:
        return changes(self.read("documents"))

    @cached_property
    def responses(self) -> DataFrame:
        return model_responses(self.read("labels"))

    @cached_property
    def rule_docs(self) -> DataFrame:
        return rule_docs(self.read("documents"))

    @cached_property
    def handbook(self) -> DataFrame:
        return handbook(self.read("benchmark"))
