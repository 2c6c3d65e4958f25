"""

Every query reads the whole given tables, or tables that were stored from them in a scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import stratakit as sk

try:
    import corpus_pipeline
    from stratakit.llm import queries as llm
except ModuleNotFoundError as error:  # that part may be left out as a whole; anything else that is missing is an error
    if error.name not in ("corpus_pipeline", "stratakit.llm"):
        raise
    corpus_pipeline = llm = None

EVENTS = """
    event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string
"""
ORDERS = """
    o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
    o_orderdate timestamp_ntz, o_orderpriority string
"""
# Both text formats keep milliseconds only unless they are told otherwise.
MICROSECONDS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

EVENT_RULES = [
    {"name": "value_over_100", "condition": "value > 100", "description": "large values"},
    {"name": "no_click", "condition": "nullif(event_type, 'error') <> 'click'"},
    {"name": "has_user", "condition": "user_id is not null"},
    {"condition": "event_id >= 0", "description": "has no name"},
    {"name": "skipped", "description": "has no condition"},
]
ORDER_RULES = [
    {"name": "positive_price", "condition": "o_totalprice > 0"},
    {"name": "known_status", "condition": "o_orderstatus in ('F', 'O', 'P')"},
]


# ---- inputs --------------------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _store(spark: SparkSession) -> sk.TableStore:
    return sk.TableStore(spark, sk.scratch_folder(spark))


def _orders_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders, as those before 1998 and those from then on."""
    orders = _table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    return orders.where(early), orders.where(~early)


def _two_versions(spark: SparkSession, sf_dir: str) -> sk.TableStore:
    store = _store(spark)
    for half in _orders_halves(spark, sf_dir):
        store.append(half, "orders")
    return store


def _three_versions(spark: SparkSession, sf_dir: str) -> sk.TableStore:
    store = _two_versions(spark, sf_dir)
    store.overwrite(_orders_halves(spark, sf_dir)[0], "orders")
    return store


def _events_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no NULL, so some are made: a fifth of the types and a few large values."""
    return _table(spark, sf_dir, "events").withColumns(
        {
            "event_type": F.nullif("event_type", F.lit("error")),
            "value": F.when(F.col("value") <= 450, F.col("value")),
        }
    )


# ---- sources, projections ------------------------------------------------------------------------


def ingest_parquet(spark, sf_dir):
    return sk.read_files(spark, "parquet", f"{sf_dir}/orders.parquet", ORDERS)


def _ingest_text(spark, sf_dir, source_format):
    folder = sk.scratch_folder(spark)
    events = _table(spark, sf_dir, "events")
    writer = events.write.options(**MICROSECONDS).format(source_format)
    (writer.option("header", "true") if source_format == "csv" else writer).save(folder)
    return sk.read_files(spark, source_format, folder, EVENTS, MICROSECONDS)


def ingest_csv(spark, sf_dir):
    return _ingest_text(spark, sf_dir, "csv")


def ingest_json(spark, sf_dir):
    return _ingest_text(spark, sf_dir, "json")


def ingest_multi_path(spark, sf_dir):
    folder = sk.scratch_folder(spark)
    paths = [f"{folder}/early", f"{folder}/late"]
    for half, path in zip(_orders_halves(spark, sf_dir), paths):
        half.write.parquet(path)
    return sk.read_files(spark, "parquet", paths, ORDERS)


def provenance(spark, sf_dir):
    path = f"{sf_dir}/lineitem.parquet"
    lineitem = sk.ingest(spark, "parquet", path, _table(spark, sf_dir, "lineitem").schema, "batch-1")
    return lineitem.groupBy(
        "batch_id",
        F.element_at(F.split("source_file", "/"), -1).alias("file_name"),
        F.col("ingestion_timestamp").isNotNull().alias("has_load_time"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


# ---- versioned tables ----------------------------------------------------------------------------


def write_append(spark, sf_dir):
    return _two_versions(spark, sf_dir).read("orders")


def write_overwrite(spark, sf_dir):
    return _three_versions(spark, sf_dir).read("orders")


def read_as_of(spark, sf_dir):
    return _two_versions(spark, sf_dir).read("orders", 0)


def read_latest(spark, sf_dir):
    store = _two_versions(spark, sf_dir)
    return store.read("orders", store.latest_version("orders"))


def schema_merge(spark, sf_dir):
    store = _store(spark)
    early, late = _orders_halves(spark, sf_dir)
    store.append(early.drop("o_orderpriority"), "orders")
    store.append(late.withColumn("price_cents", F.round(F.col("o_totalprice") * 100).cast("long")), "orders")
    return store.read("orders")


def schema_merge_upcast(spark, sf_dir):
    """Narrower numbers join a table with wider ones."""
    store = _store(spark)
    early, late = _orders_halves(spark, sf_dir)
    store.append(early, "orders")
    store.append(late.withColumns({"o_orderkey": F.col("o_orderkey").cast("int"), "o_custkey": F.col("o_custkey").cast("int")}), "orders")
    return store.read("orders")


def write_partitioned(spark, sf_dir):
    """A filter on the partition column of a table with two versions."""
    store = _store(spark)
    for half in _orders_halves(spark, sf_dir):
        store.append(half, "orders", partition_by=["o_orderpriority"])
    return store.read("orders").where("o_orderpriority like '1%'")


def table_history(spark, sf_dir):
    return _three_versions(spark, sf_dir).history("orders").select(
        "version", "operation", F.col("operationMetrics")["numOutputRows"].cast("long").alias("row_count")
    )


def latest_version(spark, sf_dir):
    """Of a missing table and of one with three versions, beside the rows of the latter."""
    store = _store(spark)
    missing = store.latest_version("orders")
    stored = _three_versions(spark, sf_dir)
    return stored.read("orders").agg(
        F.lit(missing).cast("long").alias("missing_version"),
        F.lit(stored.latest_version("orders")).cast("long").alias("stored_version"),
        F.count(F.lit(1)).alias("row_count"),
    )


def write_metrics(spark, sf_dir):
    metrics = _three_versions(spark, sf_dir).write_metrics("orders", since=0)
    return metrics.select(
        "version", F.col("operationMetrics")["numOutputRows"].cast("long").alias("row_count")
    )


def history_last_n(spark, sf_dir):
    return _three_versions(spark, sf_dir).last_history("orders", 2).select(
        "version", "operation", F.col("operationMetrics")["numOutputRows"].cast("long").alias("row_count")
    )


def table_detail(spark, sf_dir):
    store = _store(spark)
    store.append(_table(spark, sf_dir, "lineitem").repartition(40), "lineitem")
    return store.detail("lineitem").select("table_name", "version", "num_files", "num_rows")


# ---- quality -------------------------------------------------------------------------------------


def table_shape(spark, sf_dir):
    return sk.table_shape(_table(spark, sf_dir, "lineitem"))


def _rounded(df, name):
    return df.withColumn(name, F.round(name, 6))


def null_profile(spark, sf_dir):
    profile = sk.null_profile(_events_with_nulls(spark, sf_dir))
    return _rounded(profile.drop("position"), "null_pct")


def high_null_columns(spark, sf_dir):
    profile = sk.null_profile(_events_with_nulls(spark, sf_dir))
    return _rounded(sk.high_null_columns(profile).select("column_name", "null_pct"), "null_pct")


def rule_report(spark, sf_dir):
    return _rounded(sk.rule_report(_table(spark, sf_dir, "events"), EVENT_RULES), "failing_pct")


def rule_report_membership(spark, sf_dir):
    """Orders against customers, one of whom has no key; all rules from one scan of the orders."""
    _table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 50 > 0, F.col("c_custkey")).alias("key"), "c_custkey"
    ).createOrReplaceTempView("known_customers")
    rules = [
        {"name": "known", "condition": "o_custkey in (select key from known_customers)"},
        {"name": "not_in_the_first", "condition": "o_custkey not in (select c_custkey from known_customers where c_custkey < 100)"},
        {"name": "in_none", "condition": "o_custkey in (select c_custkey from known_customers where false)"},
        {"name": "positive_price", "condition": "o_totalprice > 0"},
    ]
    return _rounded(sk.rule_report(_table(spark, sf_dir, "orders"), rules), "failing_pct")


def rule_failing_rows(spark, sf_dir):
    return sk.failing_rows(_table(spark, sf_dir, "lineitem"), "l_quantity > 10 and l_discount < 0.08")


def rules_all_passed(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    sets = {"some_fail": EVENT_RULES, "all_pass": EVENT_RULES[2:4], "empty": []}
    reports = [
        sk.rules_all_passed(sk.rule_report(events, rules)).select(F.lit(name).alias("rule_set"), "all_passed")
        for name, rules in sets.items()
    ]
    return reports[0].union(reports[1]).union(reports[2])


def schema_profile(spark, sf_dir):
    return sk.schema_profile(_table(spark, sf_dir, "lineitem"))


def sample_bernoulli(spark, sf_dir):
    """What holds for any such sample: its rows are orders, none twice, and about a twentieth of all."""
    orders = _table(spark, sf_dir, "orders")
    taken = sk.sample_bernoulli(orders).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("times"))
    seen = orders.join(taken, "o_orderkey", "full").agg(
        F.count("times").alias("taken"), F.count("o_custkey").alias("known"), F.count(F.lit(1)).alias("n"),
        F.max("times").alias("times"),
    )
    spread = 5 * F.sqrt(F.col("n") * 0.05 * 0.95)
    return seen.select(
        (F.col("known") == F.col("n")).alias("all_known"),
        (F.col("times") == 1).alias("none_twice"),
        (F.abs(F.col("taken") - F.col("n") * 0.05) <= spread).alias("about_the_ratio"),
    )


def sample_capped(spark, sf_dir):
    """The size of a sample that reaches its cap, and how many of its rows are rows of the table."""
    lineitem = _table(spark, sf_dir, "lineitem")
    sample = sk.sample_capped(lineitem)
    known = lineitem.distinct().withColumn("known", F.lit(1))
    found = sample.join(known, lineitem.columns, "left")
    return found.agg(F.count(F.lit(1)).alias("row_count"), F.count("known").alias("known_rows"))


def sample_keyed(spark, sf_dir):
    return sk.sample_keyed(_table(spark, sf_dir, "orders"), ["o_orderkey"])


def sample_keyed_small(spark, sf_dir):
    return sk.sample_keyed(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 0.001)


def sample_keyed_nulls(spark, sf_dir):
    """A fifth of the rows has no key, and is in the sample by the same share."""
    orders = _table(spark, sf_dir, "orders")
    key = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_custkey"))
    return sk.sample_keyed(orders.select("o_orderkey", key.alias("o_custkey"), "o_orderpriority"), ["o_custkey"])


def sample_keyed_capped(spark, sf_dir):
    return sk.sample_keyed(_table(spark, sf_dir, "orders"), ["o_orderkey"], 0.5, 200)


def sample_reservoir(spark, sf_dir):
    """1500 rows drawn fairly from all orders in one pass, without a sort of them."""
    return sk.sample_reservoir(_table(spark, sf_dir, "orders"), ["o_orderkey"], 1500)


def sample_reused(spark, sf_dir):
    """Rules that need jobs of their own see the same capped sample as all others."""
    orders = _table(spark, sf_dir, "orders")
    _table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").createOrReplaceTempView("even_customers")
    even = "(o_custkey in (select c_custkey from even_customers) or o_totalprice < 0)"
    rules = [{"name": "even", "condition": even}, {"name": "odd", "condition": f"not {even}"}, {"name": "none", "condition": "false"}]
    report = sk.validation_report(orders, rules, 0.9, 500)
    failing = {n: r["failing_count"] for n, r in report["validation_results"].items()}
    return orders.agg(
        F.lit(report["sample_size"]).cast("long").alias("sample_size"),
        F.lit(failing["even"] + failing["odd"]).cast("long").alias("failing_either"),
        F.lit(failing["none"]).cast("long").alias("failing_none"), F.count(F.lit(1)).alias("row_count"),
    )


def approx_shape(spark, sf_dir):
    """A count with a time limit holds the true one, and a Parquet scan is counted exactly within it."""
    lineitem = _table(spark, sf_dir, "lineitem")
    true = F.lit(lineitem.count()).cast("long")
    shape = sk.approx_shape(lineitem, 60)
    return shape.select("column_count", "row_count", "is_exact", F.col("low").eqNullSafe(true).alias("low_is_true"), (F.col("high") >= true).alias("holds_true"))


def null_profile_rollup(spark, sf_dir):
    """Three writes of events with NULLs, the last with a new column: the counts of the writes, added up."""
    store = _store(spark)
    events = _events_with_nulls(spark, sf_dir)
    for i in range(3):
        part = events.where(F.col("event_id") % 3 == i)
        store.append(part.withColumn("extra", F.lit(1)) if i == 2 else part, "events")
    return _rounded(sk.stored_null_profile(store, "events").drop("position"), "null_pct")


def rule_quarantine(spark, sf_dir):
    """Clean and broken events in one write: rows of each kind, and the broken ones of each rule as read and as counted."""
    store = _store(spark)
    found = sk.quarantine(store, _events_with_nulls(spark, sf_dir), "events", EVENT_RULES)
    broken = sk.broken_rows(store, "events")
    per_rule = broken.select(F.explode("broken_rules").alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("row_count"))
    kinds = {**found["rules"], "clean": found["clean_rows"], "broken": found["broken_rows"]}
    counted = spark.createDataFrame([(k, n) for k, n in kinds.items() if n], "kind string, counted_in_write long")
    sizes = sk.clean_rows(store, "events").agg(F.lit("clean").alias("kind"), F.count(F.lit(1)).alias("row_count")).union(
        broken.agg(F.lit("broken"), F.count(F.lit(1)))
    )
    return per_rule.union(sizes).join(counted, "kind", "full")


def quarantine_clean(spark, sf_dir):
    store = _store(spark)
    sk.quarantine(store, _events_with_nulls(spark, sf_dir), "events", EVENT_RULES)
    return sk.clean_rows(store, "events")


def _broken_lines(spark, sf_dir):
    """Events as JSON lines, every tenth cut off, in a file for each type of event."""
    folder = sk.scratch_folder(spark)
    events = _table(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type", "value", "props"))
    text = F.when(F.col("event_id") % 10 == 0, F.substring(line, 1, 20)).otherwise(line)
    events.select("event_type", text.alias("value")).repartition(4, "event_type").write.partitionBy("event_type").text(folder)
    paths = [f"{folder}/event_type={r[0]}" for r in events.select("event_type").distinct().collect()]
    store = _store(spark)
    return sk.ingest_split(store, "events", "json", paths, EVENTS, "run-1", MICROSECONDS)


def ingest_malformed(spark, sf_dir):
    """The malformed lines by file type, and the good ones, as read from the table and as counted by the ingest job."""
    done = _broken_lines(spark, sf_dir)
    kind = F.regexp_extract("source_file", "event_type=([a-z]+)", 1)
    bad = done.malformed_by_file().groupBy(kind.alias("event_type")).agg(F.sum("malformed_rows").alias("malformed_rows"))
    good = done.good().groupBy("event_type").agg(F.count(F.lit(1)).alias("good_rows"), F.sum("event_id").alias("event_ids"))
    return good.join(bad, "event_type").withColumns(
        {"all_good": F.lit(done.good_rows).cast("long"), "all_malformed": F.lit(done.malformed_rows).cast("long")}
    )


def schema_merge_nested(spark, sf_dir):
    """Structs, arrays and maps grow by fields and wider numbers; the old rows are read in the new types."""
    store = _store(spark)
    early, late = _orders_halves(spark, sf_dir)

    def nested(orders, key, price, more=()):
        item = F.struct(F.col("o_orderkey").cast(key).alias("key"), *more)
        return orders.select(
            "o_orderkey", item.alias("item"), F.array(item).alias("items"),
            F.create_map(F.lit("price"), F.col("o_totalprice").cast(price)).alias("prices"),
        )

    store.append(nested(early, "int", "float"), "orders")
    store.append(nested(late, "long", "double", [F.col("o_orderstatus").alias("status")]), "orders", widen=True)
    return store.read("orders").select(
        "o_orderkey", F.col("item.key").alias("item_key"), F.col("item.status").alias("item_status"),
        F.col("items")[0]["key"].alias("items_key"), F.col("items")[0]["status"].alias("items_status"),
        F.round(F.col("prices")["price"] / 1000).alias("price"),
        F.lit(store.read("orders", 0).schema["item"].dataType.simpleString()).alias("old_type"),
    )


def late_failures(spark, sf_dir):
    """Rows that break a rule stand at the end of the table; a bronze run with default checks counts them all."""
    path = f"{sf_dir}/lineitem.parquet"
    last = _table(spark, sf_dir, "lineitem").agg(F.max("l_orderkey")).head()[0]
    rules = [{"name": "not_at_the_end", "condition": f"l_orderkey < {last} * 0.9"}]
    store = _store(spark)
    folder = sk.scratch_folder(spark)
    _table(spark, sf_dir, "lineitem").orderBy("l_orderkey").write.parquet(folder)
    result = sk.run_bronze(
        store, "parquet", folder, _table(spark, sf_dir, "lineitem").schema, "bronze", validation_rules=rules, mode="write"
    )
    report = result.validation
    failing = report["validation_results"]["not_at_the_end"]["failing_count"]
    return store.read("bronze").agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(failing).cast("long").alias("failing_count"),
        F.lit(report["sample_size"]).cast("long").alias("sample_size"), F.lit(report["cap_reached"]).alias("cap_reached"),
    )


# ---- layout --------------------------------------------------------------------------------------


def _fragmented(spark, sf_dir):
    store = _store(spark)
    store.append(_table(spark, sf_dir, "lineitem").repartition(40), "lineitem")
    return store


def optimize_compact(spark, sf_dir):
    store = _fragmented(spark, sf_dir)
    return store.read("lineitem", sk.compact(store, "lineitem"))


def optimize_zorder(spark, sf_dir):
    """A small target size, so that the test tables still give several files."""
    store = _fragmented(spark, sf_dir)
    target = max(1, store.snapshot("lineitem").bytes // 16)
    version = sk.zorder(store, "lineitem", ["l_partkey", "l_suppkey"], target_file_bytes=target)
    return store.read("lineitem", version)


def compact_mixed(spark, sf_dir):
    """One large and 50 small files: the small ones become one, the large one stays."""
    store = _store(spark)
    early, late = _orders_halves(spark, sf_dir)
    store.append(early.coalesce(1), "orders")
    store.append(late.repartition(50), "orders")
    size = store.snapshot("orders").folders[0].bytes
    after = store.snapshot("orders", sk.compact(store, "orders", target_file_bytes=size))
    return store.read_snapshot(after).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
        F.lit(after.files <= 4).alias("few_files"),
        F.lit(any(f.rows == early.count() for f in after.folders)).alias("large_file_stays"),
    )


def zorder_overlap(spark, sf_dir):
    """Files that can hold a point, on average over all rows' parts, stay few."""
    store = _fragmented(spark, sf_dir)
    target = max(1, store.snapshot("lineitem").bytes // 16)
    version = sk.zorder(store, "lineitem", ["l_partkey"], target_file_bytes=target)
    rows = store.read("lineitem", version)
    files = rows.groupBy(rows.metadataColumn("_metadata").getField("file_path").alias("file")).agg(
        F.min("l_partkey").alias("low"), F.max("l_partkey").alias("high"), F.count(F.lit(1)).alias("n")
    )
    points = rows.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("own"))
    hits = points.join(F.broadcast(files), F.expr("l_partkey between low and high"))
    return hits.agg((F.count(F.lit(1)) / F.countDistinct("l_partkey") <= 1.5).alias("separate_ranges")).crossJoin(
        files.agg((F.count(F.lit(1)) >= 8).alias("several_files"), F.sum("n").alias("row_count"))
    )


def zorder_two_columns(spark, sf_dir):
    """Of the files of a table clustered by two columns a point of either is in less than half, on average."""
    store = _fragmented(spark, sf_dir)
    target = max(1, store.snapshot("lineitem").bytes // 16)
    rows = store.read("lineitem", sk.zorder(store, "lineitem", ["l_orderkey", "l_partkey"], target_file_bytes=target))
    file = rows.metadataColumn("_metadata").getField("file_path").alias("file")
    found = rows.agg(F.count(F.lit(1)).alias("row_count"))
    for column in ("l_orderkey", "l_partkey"):
        files = rows.groupBy(file).agg(F.min(column).alias("low"), F.max(column).alias("high"))
        points = rows.select(F.col(column).alias("point")).distinct()
        hits = points.join(F.broadcast(files), F.expr("point between low and high")).groupBy("point").count()
        share = F.avg("count") / F.lit(store.snapshot("lineitem").files)
        found = found.join(hits.agg((share < 0.5).alias(f"{column}_is_narrow")))
    return found


def zorder_incremental(spark, sf_dir):
    """A clustered table, appends in the order of its key and appends all over it: how far runs and files overlap, and
    how much of the table was written again, the appended rows included."""
    store = _store(spark)
    orders = _table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    late, odd = F.col("o_orderkey") > last * 0.9, F.col("o_orderkey") % 40 == 3
    store.append(orders.where(~late & ~odd), "orders")
    target = max(1, store.snapshot("orders").bytes // 16)
    sk.zorder_incremental(store, "orders", ["o_orderkey"], target)
    base = store.latest_version("orders")
    for rows in (late & ~odd, odd & (F.col("o_custkey") % 2 == 0), odd & (F.col("o_custkey") % 2 == 1)):
        store.append(orders.where(rows), "orders")
        sk.zorder_incremental(store, "orders", ["o_orderkey"], target)
    written = sum(int(m["numOutputRows"]) for m in store.metrics_since("orders", base) if "numRemovedFiles" in m)
    snapshot = store.snapshot("orders")
    rows = store.read_with_folders(snapshot, snapshot.folders)
    ends = [F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")]
    files = store.read("orders")
    files = files.groupBy(files.metadataColumn("_metadata").getField("file_path").alias("file")).agg(*ends)

    def hits(ranges):
        return rows.join(F.broadcast(ranges), F.expr("o_orderkey between low and high")).groupBy("o_orderkey").count()

    return (
        rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"))
        .join(hits(rows.groupBy("__folder").agg(*ends)).agg((F.max("count") <= 2).alias("two_runs_at_most")))
        .join(hits(files).agg((F.avg("count") <= 2).alias("two_files_on_average")))
        .select("*", F.lit(2 * written < snapshot.rows).alias("less_than_half_rewritten"))
    )


def optimize_report(spark, sf_dir):
    store = _fragmented(spark, sf_dir)
    return sk.optimize_report(store, "lineitem", 0, sk.compact(store, "lineitem"))


# ---- layers --------------------------------------------------------------------------------------


def _clean(orders: DataFrame) -> DataFrame:
    return (
        orders.where("o_totalprice > 1000")
        .withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
        .drop("ingestion_timestamp", "source_file")
    )


def _summaries(silver: DataFrame) -> dict[str, DataFrame]:
    # Prices have two decimals; as decimals their sum does not depend on the order of the rows.
    revenue = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue")
    orders = F.count(F.lit(1)).alias("order_count")
    return {
        "monthly": silver.groupBy("order_month").agg(orders, revenue),
        "priority": silver.groupBy("o_orderpriority").agg(orders, revenue),
    }


def _bronze(store, sf_dir, mode="write"):
    return sk.run_bronze(
        store, "parquet", f"{sf_dir}/orders.parquet", ORDERS, "bronze_orders",
        validation_rules=ORDER_RULES, pipeline_id="run-1", mode=mode,
    )


def _silver(store, mode="write", **kwargs):
    return sk.run_silver(
        store, "bronze_orders", None, "silver_orders", _clean, ORDER_RULES, "run-1", mode, **kwargs
    )


def _gold(store, mode="write", **kwargs):
    return sk.run_gold(
        store, "silver_orders", None, "gold", _summaries, pipeline_id="run-1", mode=mode, **kwargs
    )


def bronze_layer(spark, sf_dir):
    store = _store(spark)
    _bronze(store, sf_dir)
    return store.read("bronze_orders").drop("ingestion_timestamp", "source_file")


def silver_layer(spark, sf_dir):
    store = _store(spark)
    _bronze(store, sf_dir)
    _silver(store)
    return store.read("silver_orders")


def _all_layers(spark, sf_dir):
    store = _store(spark)
    _bronze(store, sf_dir)
    _silver(store)
    _gold(store)
    return store


def gold_layer(spark, sf_dir):
    return _all_layers(spark, sf_dir).read("gold_monthly")


def gold_fan_out(spark, sf_dir):
    store = _all_layers(spark, sf_dir)
    return store.read("gold_monthly").select(F.lit("monthly").alias("name"), "order_count").union(
        store.read("gold_priority").select(F.lit("priority").alias("name"), "order_count")
    ).groupBy("name").agg(F.count(F.lit(1)).alias("row_count"), F.sum("order_count").alias("order_count"))


def checkpoint_log(spark, sf_dir):
    return sk.read_checkpoints(_all_layers(spark, sf_dir), "run-1").select(
        "pipeline_id",
        "layer",
        "table_name",
        "version",
        F.get_json_object("metadata", "$.write_metrics[0].numOutputRows").cast("long").alias("row_count"),
    )


def lineage(spark, sf_dir):
    """A second bronze version before silver, so the versions of the layers differ."""
    store = _store(spark)
    _bronze(store, sf_dir)
    _bronze(store, sf_dir)
    _silver(store)
    _gold(store)
    rows = F.get_json_object("metadata", "$.write_metrics[0].numOutputRows").cast("long")
    return sk.read_checkpoints(store).select("layer", "version", "source_version", rows.alias("row_count"))


def dry_run(spark, sf_dir):
    """All three layers in test mode, chained on frames: rows of the result, tables written."""
    store = _store(spark)
    bronze = _bronze(store, sf_dir, mode="test")
    silver = _silver(store, mode="test", source=bronze.df)
    gold = _gold(store, mode="test", source=silver.df)
    written = sum(store.exists(t) for t in ("bronze_orders", "silver_orders", "gold_monthly"))
    return gold["monthly"].df.agg(
        F.count(F.lit(1)).alias("month_count"),
        F.sum("order_count").alias("order_count"),
        F.lit(written).cast("long").alias("tables_written"),
    )


def _pipeline(spark, sf_dir, **options):
    store = _store(spark)
    result = sk.run_pipeline(
        store, "parquet", f"{sf_dir}/orders.parquet", ORDERS,
        bronze_table="bronze_orders", silver_table="silver_orders", gold_table="gold",
        silver_transform=_clean, gold_transform=_summaries,
        bronze_validation_rules=ORDER_RULES, silver_validation_rules=ORDER_RULES,
        pipeline_name="orders", silver_zorder_columns=["o_orderdate", "o_orderpriority"],
        raise_on_error=True, **options,
    )
    return store, result


def stage_metrics(spark, sf_dir):
    stages = sk.stage_metrics(spark, _pipeline(spark, sf_dir)[1])
    timed = (F.col("duration_seconds") > 0).alias("is_timed")
    return stages.select("position", "stage", "status", timed)


def full_pipeline(spark, sf_dir):
    store, result = _pipeline(spark, sf_dir)
    return store.read("gold_monthly", result["gold_versions"]["gold_monthly"])


def silver_written_once(spark, sf_dir):
    """A run that clusters silver in its only write: folders, files, and files that can hold a point in time."""
    store = _store(spark)
    _bronze(store, sf_dir)
    target = max(1, store.snapshot("bronze_orders").bytes // 16)
    result = sk.run_pipeline(
        store, "parquet", f"{sf_dir}/orders.parquet", ORDERS, "bronze", "silver", "gold",
        silver_transform=_clean, gold_transform=_summaries, silver_zorder_columns=["o_orderdate"],
        target_file_bytes=target, cluster_in_write=True, raise_on_error=True,
    )
    silver = store.snapshot("silver", result["silver_version"])
    rows = store.read_snapshot(silver)
    files = rows.groupBy(rows.metadataColumn("_metadata").getField("file_path").alias("file")).agg(
        F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"), F.count(F.lit(1)).alias("n")
    )
    points = rows.groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("own"))
    hits = points.join(F.broadcast(files), F.expr("o_orderdate between low and high"))
    overlap = hits.agg((F.count(F.lit(1)) / F.countDistinct("o_orderdate") <= 1.5).alias("separate_ranges"))
    return overlap.join(files.agg((F.count(F.lit(1)) >= 8).alias("several_files"), F.sum("n").alias("row_count"))).select(
        "*", F.lit(len(silver.folders)).cast("long").alias("folders"), F.lit(silver.version).cast("long").alias("version"),
    )


def _two_inputs(spark, sf_dir, **options):
    """Two runs over the two halves of the orders, which lie in a folder each."""
    folder = sk.scratch_folder(spark)
    store = _store(spark)
    for i, half in enumerate(_orders_halves(spark, sf_dir)):
        half.write.parquet(f"{folder}/{i}")
        result = sk.run_pipeline(
            store, "parquet", f"{folder}/{i}", ORDERS, "bronze", "silver", "gold",
            silver_transform=_clean, gold_transform=_summaries, raise_on_error=True, incremental=True, **options,
        )
    return store, result


def incremental_run(spark, sf_dir):
    """The second run reads the second half only; the monthly table equals that of a whole run."""
    store, result = _two_inputs(spark, sf_dir)
    return store.read("gold_monthly", result["gold_versions"]["gold_monthly"])


def incremental_writes(spark, sf_dir):
    """What the two runs wrote to silver, and whether it now holds the last version of bronze."""
    store, result = _two_inputs(spark, sf_dir)
    current = store.consumed("silver", "bronze") == result["bronze_version"]
    return store.history("silver").where("operation <> 'OPTIMIZE'").select(
        "operation", F.col("operationMetrics")["numOutputRows"].cast("long").alias("row_count"), F.lit(current).alias("is_current")
    )


def merge_upsert(spark, sf_dir):
    """Late orders at twice their price, and as many new ones, merged into all orders by key."""
    store = _two_versions(spark, sf_dir)
    late = _orders_halves(spark, sf_dir)[1]
    changed = late.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    new = late.withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    store.merge(changed.union(new), "orders", ["o_orderkey"])
    return store.read("orders")


def failed_run(spark, sf_dir):
    """A run whose gold transform raises: how each stage ended, and the rows stored until then."""

    def broken(silver):
        raise ValueError("no gold today")

    store = _store(spark)
    result = sk.run_pipeline(
        store, "parquet", f"{sf_dir}/orders.parquet", ORDERS,
        bronze_table="bronze_orders", silver_table="silver_orders", gold_table="gold",
        silver_transform=_clean, gold_transform=broken,
    )
    stages = sk.stage_metrics(spark, result).select("position", "stage", "status", F.lit(result["status"]).alias("run_status"))
    rows = {t: store.read(t).agg(F.count(F.lit(1)).alias("row_count")).withColumn("stage", F.lit(s))
            for t, s in (("bronze_orders", "bronze"), ("silver_orders", "silver"))}
    return stages.join(rows["bronze_orders"].union(rows["silver_orders"]), "stage", "left")


def run_ids(spark, sf_dir):
    """Ids of two runs over all orders differ, and a mode other than test and write is refused before any job."""
    ids = [_pipeline(spark, sf_dir)[1]["pipeline_id"] for _ in range(2)]
    try:
        _bronze(_store(spark), sf_dir, mode="dry")
        refused = False
    except ValueError:
        refused = True
    return _table(spark, sf_dir, "orders").agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(ids[0] != ids[1]).alias("ids_differ"), F.lit(refused).alias("mode_refused")
    )


# ---- contract ------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: files to bronze to silver to gold, and the monthly gold table."""
    return full_pipeline(spark, "/root/testdata/sf0.001")


_QUERIES = (
    ingest_parquet, ingest_csv, ingest_json, ingest_multi_path, provenance,
    write_append, write_overwrite, read_as_of, read_latest, schema_merge, schema_merge_upcast, write_partitioned,
    table_history, latest_version, write_metrics, history_last_n, table_detail,
    table_shape, null_profile, high_null_columns, rule_report, rule_report_membership, rule_failing_rows,
    rules_all_passed, schema_profile, sample_bernoulli, sample_capped, sample_keyed,
    sample_keyed_small, sample_keyed_nulls, sample_keyed_capped, late_failures,
    optimize_compact, optimize_zorder, optimize_report, compact_mixed, zorder_overlap,
    bronze_layer, silver_layer, gold_layer, gold_fan_out, checkpoint_log, lineage,
    dry_run, stage_metrics, full_pipeline, failed_run, run_ids,
    sample_reservoir, sample_reused, approx_shape, null_profile_rollup, rule_quarantine, quarantine_clean,
    ingest_malformed, schema_merge_nested, zorder_two_columns, zorder_incremental,
    silver_written_once, incremental_run, incremental_writes, merge_upsert,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {query.__name__: query for query in _QUERIES}
    return own if llm is None else own | llm.queries() | {"pipeline": corpus_pipeline.run}


_EARLY = "o_orderdate < TIMESTAMP '1998-01-01'"
_COUNT_EARLY = f"(SELECT count(*) FROM orders WHERE {_EARLY})"
_COUNT_LATE = f"(SELECT count(*) FROM orders WHERE NOT ({_EARLY}))"
_COUNT_ALL = "(SELECT count(*) FROM orders)"
_SILVER = """
    SELECT *, 'run-1' AS batch_id, strftime(o_orderdate, '%Y-%m') AS order_month
    FROM orders WHERE o_totalprice > 1000
"""
_COUNT_SILVER = "(SELECT count(*) FROM orders WHERE o_totalprice > 1000)"
_MONTHS = "(SELECT count(DISTINCT date_trunc('month', o_orderdate)) FROM orders WHERE o_totalprice > 1000)"
_PRIORITIES = "(SELECT count(DISTINCT o_orderpriority) FROM orders WHERE o_totalprice > 1000)"
_MONTHLY = f"""
    SELECT order_month, count(*) AS order_count, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS revenue
    FROM ({_SILVER}) GROUP BY order_month
"""
_NULLED = """
    SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type,
           CASE WHEN value <= 450 THEN value END AS value, props FROM events
"""
_NULL_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS sample_size, count(*) - count({c}) AS null_count,
        round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS null_pct FROM ({_NULLED})"""
    for c in ("event_id", "ts", "user_id", "event_type", "value", "props")
)
_HISTORY = f"""
    SELECT 0::BIGINT AS version, 'APPEND' AS operation, {_COUNT_EARLY} AS row_count
    UNION ALL SELECT 1, 'APPEND', {_COUNT_LATE}
    UNION ALL SELECT 2, 'OVERWRITE', {_COUNT_EARLY}
"""
_RULES = " UNION ALL ".join(
    f"""SELECT '{name}' AS rule_name, '{description}' AS description, count(*) AS sample_size,
        count(*) FILTER (WHERE NOT ({condition})) AS failing_count,
        count(*) FILTER (WHERE ({condition}) IS NULL) AS unknown_count,
        round((count(*) FILTER (WHERE NOT ({condition}))) * 100.0::DOUBLE / count(*), 6) AS failing_pct,
        (count(*) FILTER (WHERE NOT ({condition}))) = 0 AS passed FROM events"""
    for name, condition, description in (
        ("value_over_100", "value > 100", "large values"),
        ("no_click", "nullif(event_type, 'error') <> 'click'", ""),
        ("has_user", "user_id IS NOT NULL", ""),
        ("unnamed_rule", "event_id >= 0", "has no name"),
    )
)




def _md5(*keys: str) -> str:
    return "md5(" + " || ".join(
        f"CASE WHEN {k} IS NULL THEN 'N' ELSE 'V' || length({k}::VARCHAR) || ':' || {k} END" for k in keys
    ) + ")"


def _low(digest: str, ratio: float) -> str:
    return f"('0x' || substr({digest}, 1, 15))::BIGINT < {round(ratio * (1 << 60))}"


_MEMBER_RULES = " UNION ALL ".join(
    f"""SELECT '{name}' AS rule_name, '' AS description, count(*) AS sample_size,
        count(*) FILTER (WHERE NOT ({condition})) AS failing_count,
        count(*) FILTER (WHERE ({condition}) IS NULL) AS unknown_count,
        round((count(*) FILTER (WHERE NOT ({condition}))) * 100.0::DOUBLE / count(*), 6) AS failing_pct,
        (count(*) FILTER (WHERE NOT ({condition}))) = 0 AS passed FROM orders"""
    for name, condition in (
        ("known", "o_custkey IN (SELECT CASE WHEN c_custkey % 50 > 0 THEN c_custkey END FROM customer)"),
        ("not_in_the_first", "o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey < 100)"),
        ("in_none", "o_custkey IN (SELECT c_custkey FROM customer WHERE false)"),
        ("positive_price", "o_totalprice > 0"),
    )
)
_TAGGED = f"""
    SELECT *, list_filter([CASE WHEN NOT (value > 100) THEN 'value_over_100' END,
                           CASE WHEN NOT (nullif(event_type, 'error') <> 'click') THEN 'no_click' END,
                           CASE WHEN NOT (user_id IS NOT NULL) THEN 'has_user' END,
                           CASE WHEN NOT (event_id >= 0) THEN 'unnamed_rule' END], lambda x: x IS NOT NULL) AS b
    FROM ({_NULLED})
"""
_STAGES = ("bronze", "bronze_optimize", "silver", "silver_optimize", "gold", "gold_optimize")


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return _oracle_sql()
    ends = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return _oracle_sql() | llm.oracle_sql() | ends


def _oracle_sql() -> dict[str, str]:
    orders, lineitem = "SELECT * FROM orders", "SELECT * FROM lineitem"
    return {
        "ingest_parquet": orders,
        "ingest_csv": "SELECT * FROM events",
        "ingest_json": "SELECT * FROM events",
        "ingest_multi_path": orders,
        "provenance": """
            SELECT 'batch-1' AS batch_id, 'lineitem.parquet' AS file_name, true AS has_load_time,
                   count(*) AS row_count FROM lineitem
        """,
        "write_append": orders,
        "write_overwrite": f"SELECT * FROM orders WHERE {_EARLY}",
        "read_as_of": f"SELECT * FROM orders WHERE {_EARLY}",
        "read_latest": orders,
        "schema_merge": f"""
            SELECT * EXCLUDE (o_orderpriority) FROM orders WHERE {_EARLY}
            UNION ALL BY NAME
            SELECT *, round(o_totalprice * 100)::BIGINT AS price_cents FROM orders WHERE NOT ({_EARLY})
        """,
        "table_history": _HISTORY,
        "latest_version": f"""
            SELECT -1::BIGINT AS missing_version, 2::BIGINT AS stored_version, count(*) AS row_count
            FROM orders WHERE {_EARLY}
        """,
        "write_metrics": f"SELECT version, row_count FROM ({_HISTORY}) WHERE version > 0",
        "history_last_n": f"SELECT * FROM ({_HISTORY}) ORDER BY version DESC LIMIT 2",
        "table_detail": """
            SELECT 'lineitem' AS table_name, 0::BIGINT AS version, 40::BIGINT AS num_files,
                   count(*) AS num_rows FROM lineitem
        """,
        "table_shape": """
            SELECT (SELECT count(*) FROM (DESCRIBE lineitem)) AS column_count, count(*) AS row_count
            FROM lineitem
        """,
        "null_profile": _NULL_PROFILE,
        "high_null_columns": f"SELECT column_name, null_pct FROM ({_NULL_PROFILE}) WHERE null_pct > 5",
        "rule_report": _RULES,
        "rule_report_membership": _MEMBER_RULES,
        "rule_failing_rows": "SELECT * FROM lineitem WHERE NOT (l_quantity > 10 AND l_discount < 0.08)",
        "rules_all_passed": f"""
            SELECT 'some_fail' AS rule_set, bool_and(passed) AS all_passed FROM ({_RULES})
            UNION ALL SELECT 'all_pass', bool_and(passed) FROM ({_RULES})
                WHERE rule_name IN ('has_user', 'unnamed_rule')
            UNION ALL SELECT 'empty', coalesce(bool_and(passed), true) FROM ({_RULES}) WHERE false
        """,
        "sample_keyed": f"SELECT * FROM orders WHERE {_low(_md5('o_orderkey'), 0.05)}",
        "sample_keyed_small": f"SELECT * FROM lineitem WHERE {_low(_md5('l_orderkey', 'l_linenumber'), 0.001)}",
        "sample_keyed_nulls": f"""
            WITH keyed AS (
                SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey END AS o_custkey, o_orderpriority FROM orders
            )
            SELECT * FROM keyed WHERE CASE WHEN o_custkey IS NULL
                THEN {_low(_md5('o_custkey', 'o_orderkey', 'o_orderpriority'), 0.05)}
                ELSE {_low(_md5('o_custkey'), 0.05)} END
        """,
        "sample_keyed_capped": f"""
            SELECT * FROM orders WHERE {_low(_md5('o_orderkey'), 0.5)} ORDER BY {_md5('o_orderkey')} LIMIT 200
        """,
        "sample_bernoulli": """
            SELECT true AS all_known, true AS none_twice, count(*) > 0 AS about_the_ratio FROM orders
        """,
        "sample_capped": """
            SELECT least(count(*), 1000)::BIGINT AS row_count, least(count(*), 1000)::BIGINT AS known_rows
            FROM lineitem
        """,
        "late_failures": """
            SELECT count(*) AS row_count, count(*) FILTER (WHERE l_orderkey >= m * 0.9) AS failing_count,
                   count(*) AS sample_size, false AS cap_reached
            FROM lineitem, (SELECT max(l_orderkey) AS m FROM lineitem)
        """,
        "compact_mixed": """
            SELECT count(*) AS row_count, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS revenue,
                   true AS few_files, true AS large_file_stays FROM orders
        """,
        "zorder_overlap": """
            SELECT true AS separate_ranges, true AS several_files, count(*) AS row_count FROM lineitem
        """,
        "schema_merge_upcast": orders,
        "write_partitioned": "SELECT * FROM orders WHERE o_orderpriority LIKE '1%'",
        "failed_run": f"""
            SELECT * FROM (VALUES
                (0::INTEGER, 'bronze', 'success', 'failed', {_COUNT_ALL}),
                (1, 'bronze_optimize', 'success', 'failed', NULL),
                (2, 'silver', 'success', 'failed', {_COUNT_SILVER}),
                (3, 'silver_optimize', 'success', 'failed', NULL),
                (4, 'gold', 'failed', 'failed', NULL)
            ) AS t(position, stage, status, run_status, row_count)
        """,
        "run_ids": "SELECT count(*) AS row_count, true AS ids_differ, true AS mode_refused FROM orders",
        "optimize_compact": lineitem,
        "optimize_zorder": lineitem,
        "bronze_layer": "SELECT *, 'run-1' AS batch_id FROM orders",
        "silver_layer": _SILVER,
        "gold_layer": _MONTHLY,
        "gold_fan_out": f"""
            SELECT 'monthly' AS name, {_MONTHS} AS row_count, {_COUNT_SILVER} AS order_count
            UNION ALL SELECT 'priority', {_PRIORITIES}, {_COUNT_SILVER}
        """,
        "checkpoint_log": f"""
            SELECT 'run-1' AS pipeline_id, 'bronze' AS layer, 'bronze_orders' AS table_name,
                   0::BIGINT AS version, {_COUNT_ALL} AS row_count
            UNION ALL SELECT 'run-1', 'silver', 'silver_orders', 0, {_COUNT_SILVER}
            UNION ALL SELECT 'run-1', 'gold_monthly', 'gold_monthly', 0, {_MONTHS}
            UNION ALL SELECT 'run-1', 'gold_priority', 'gold_priority', 0, {_PRIORITIES}
        """,
        "lineage": f"""
            SELECT 'bronze' AS layer, 0::BIGINT AS version, NULL::BIGINT AS source_version,
                   {_COUNT_ALL} AS row_count
            UNION ALL SELECT 'bronze', 1, NULL, {_COUNT_ALL}
            UNION ALL SELECT 'silver', 0, 1, 2 * {_COUNT_SILVER}
            UNION ALL SELECT 'gold_monthly', 0, 0, {_MONTHS}
            UNION ALL SELECT 'gold_priority', 0, 0, {_PRIORITIES}
        """,
        "dry_run": f"""
            SELECT {_MONTHS} AS month_count, {_COUNT_SILVER} AS order_count, 0::BIGINT AS tables_written
        """,
        "full_pipeline": _MONTHLY,
        "sample_reservoir": f"SELECT * FROM orders ORDER BY {_md5('o_orderkey')} LIMIT 1500",
        "sample_reused": """
            SELECT 500::BIGINT AS sample_size, 500::BIGINT AS failing_either, 500::BIGINT AS failing_none,
                   count(*) AS row_count FROM orders
        """,
        "approx_shape": """
            SELECT (SELECT count(*) FROM (DESCRIBE lineitem)) AS column_count, count(*) AS row_count, true AS is_exact,
                   true AS low_is_true, true AS holds_true FROM lineitem
        """,
        "null_profile_rollup": f"""
            {_NULL_PROFILE} UNION ALL
            SELECT 'extra', count(*), count(*) FILTER (WHERE event_id % 3 < 2),
                   round((count(*) FILTER (WHERE event_id % 3 < 2)) * 100.0::DOUBLE / count(*), 6) FROM events
        """,
        "rule_quarantine": f"""
            WITH kinds AS (
                SELECT unnest(list_concat(
                    [CASE WHEN len(b) > 0 THEN 'broken' ELSE 'clean' END], b)) AS kind FROM ({_TAGGED})
            ) SELECT kind, count(*) AS row_count, count(*) AS counted_in_write FROM kinds GROUP BY kind
        """,
        "quarantine_clean": f"SELECT * EXCLUDE (b) FROM ({_TAGGED}) WHERE len(b) = 0",
        "ingest_malformed": """
            SELECT event_type, count(*) FILTER (WHERE event_id % 10 > 0) AS good_rows,
                   sum(event_id) FILTER (WHERE event_id % 10 > 0)::BIGINT AS event_ids,
                   count(*) FILTER (WHERE event_id % 10 = 0) AS malformed_rows,
                   (SELECT count(*) FROM events WHERE event_id % 10 > 0) AS all_good,
                   (SELECT count(*) FROM events WHERE event_id % 10 = 0) AS all_malformed
            FROM events GROUP BY event_type
        """,
        "schema_merge_nested": f"""
            SELECT o_orderkey, o_orderkey AS item_key, CASE WHEN NOT ({_EARLY}) THEN o_orderstatus END AS item_status,
                   o_orderkey AS items_key, CASE WHEN NOT ({_EARLY}) THEN o_orderstatus END AS items_status,
                   round(CASE WHEN {_EARLY} THEN o_totalprice::FLOAT::DOUBLE ELSE o_totalprice END / 1000) AS price,
                   'struct<key:int>' AS old_type FROM orders
        """,
        "zorder_incremental": """
            SELECT count(*) AS row_count, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS revenue, true AS two_runs_at_most,
                   true AS two_files_on_average, true AS less_than_half_rewritten FROM orders
        """,
        "zorder_two_columns": """
            SELECT count(*) AS row_count, true AS l_orderkey_is_narrow, true AS l_partkey_is_narrow FROM lineitem
        """,
        "silver_written_once": f"""
            SELECT true AS separate_ranges, true AS several_files, {_COUNT_SILVER} AS row_count, 1::BIGINT AS folders,
                   0::BIGINT AS version FROM orders LIMIT 1
        """,
        "incremental_run": _MONTHLY,
        "incremental_writes": f"""
            SELECT 'OVERWRITE' AS operation, true AS is_current,
                   (SELECT count(*) FROM orders WHERE o_totalprice > 1000 AND {_EARLY}) AS row_count
            UNION ALL SELECT 'APPEND', true, (SELECT count(*) FROM orders WHERE o_totalprice > 1000 AND NOT ({_EARLY}))
        """,
        "merge_upsert": f"""
            SELECT * FROM orders WHERE {_EARLY}
            UNION ALL SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders WHERE NOT ({_EARLY})
            UNION ALL SELECT * REPLACE (-o_orderkey - 1 AS o_orderkey) FROM orders WHERE NOT ({_EARLY})
        """,
        "stage_metrics": " UNION ALL ".join(
            f"SELECT {i}::INTEGER AS position, '{stage}' AS stage, 'success' AS status, true AS is_timed"
            for i, stage in enumerate(_STAGES)
        ),
        "schema_profile": """
            SELECT (row_number() OVER () - 1)::INTEGER AS position, column_name,
                   CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
                        WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS data_type,
                   true AS nullable, value_count
            FROM (DESCRIBE lineitem) JOIN (UNPIVOT (SELECT count(COLUMNS(*)) FROM lineitem)
                ON COLUMNS(*) INTO NAME column_name VALUE value_count) USING (column_name)
        """,
        # The table is smaller than one file of the target size.
        "optimize_report": """
            SELECT 'lineitem' AS table_name, 40::BIGINT AS files_before, 1::BIGINT AS files_after
            FROM lineitem LIMIT 1
        """,
    }
