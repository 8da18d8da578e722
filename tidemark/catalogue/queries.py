"""One query per operator: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.catalogue.inputs import (
    DRIFT_COLUMNS,
    EVENT_SPLIT,
    LINE_KEY,
    TABLES,
    dirty_orders,
    labelled_documents,
    lines_by_side,
    lines_halves,
    load,
    moment,
    r6,
    ruled_lines,
)
from tidemark.functions import snapshot_stamp
from tidemark.operators import (
    categories,
    clean,
    drift,
    histograms,
    metrics,
    models,
    sampling,
    scaling,
    summaries,
)
from tidemark.plans import lifecycle
from tidemark.plans.prepare import fit_state, prepare, prepare_snapshot, to_features
from tidemark.session import scratch_path, stage
from tidemark.sources import csv, ledgers, snapshots
from tidemark.sources.ledgers import Registry
from tidemark.spec import FeatureSpec, column_roles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PRICE_RULE, PRICE_MARGIN, PRICE_STEP = 250_000.0, 60_000.0, 20_000.0
QUALITY = FeatureSpec(label="quality", key=["doc_id"])


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- sources and sinks ------------------------------------------------------


@query
def csv_roundtrip(spark, folder):
    part = load(spark, folder, "part")
    path = scratch_path(spark, "part-csv")
    csv.write_csv(part, path)
    return csv.read_csv(spark, path, part.schema)


@query
def csv_inferred(spark, folder):
    path = scratch_path(spark, "customer-csv")
    csv.write_csv(load(spark, folder, "customer"), path)
    read = csv.read_csv(spark, path)
    return read.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
    )


@query
def snapshot_roundtrip(spark, folder):
    root = scratch_path(spark, "snapshots")
    orders = load(spark, folder, "orders").drop("o_orderdate")
    snapshots.write_snapshot(sampling.split(orders, ["o_orderkey"]), root, "20240101000000")
    return snapshots.read_snapshot(spark, root, "20240101000000")


@query
def snapshot_one_side(spark, folder):
    root = scratch_path(spark, "snapshots")
    orders = load(spark, folder, "orders").drop("o_orderdate")
    snapshots.write_snapshot(sampling.split(orders, ["o_orderkey"]), root, "20240101000000")
    return snapshots.read_snapshot(spark, root, "20240101000000", sampling.TEST)


@query
def snapshot_csv_roundtrip(spark, folder):
    root = scratch_path(spark, "snapshots-csv")
    orders = load(spark, folder, "orders").drop("o_orderdate")
    snapshots.write_snapshot_csv(sampling.split(orders, ["o_orderkey"]), root, "20240101000000")
    return snapshots.read_snapshot_csv(spark, root, "20240101000000", orders.schema)


@query
def snapshot_ids(spark, folder):
    events = load(spark, folder, "events")
    return events.select("event_id", snapshot_stamp(F.col("ts")).alias("snapshot_id"))


@query
def ledger_last(spark, folder):
    # A ledger whose records are the events, appended as two; its last record, and one more.
    schema = "seq bigint, snapshot_id string, value double"
    ledger = ledgers.Ledger(spark, scratch_path(spark, "ledger"), schema)
    records = load(spark, folder, "events").select(
        F.col("event_id").alias("seq"), snapshot_stamp(F.col("ts")).alias("snapshot_id"), "value"
    )
    low = F.coalesce(F.col("value") < 10, F.lit(False))
    for half in (low, ~low):
        ledger.append_table(records.where(half))
    seq, snapshot_id = ledger.last("seq", "snapshot_id")
    added = ledger.append(snapshot_id=snapshot_id, value=None)
    counted = ledger.read().agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumns(
        {
            "seq": F.lit(seq).cast("bigint"),
            "snapshot_id": F.lit(snapshot_id),
            "added": F.lit(added).cast("bigint"),
        }
    )


@query
def json_ledger(spark, folder):
    # Stamps of the first event of each day, in a ledger of the older form: one JSON array.
    days = load(spark, folder, "events").groupBy(F.to_date("ts").alias("day")).agg(F.min("ts").alias("ts"))
    stamps = F.sort_array(F.collect_list(F.struct(snapshot_stamp(F.col("ts")).alias("timestamp"))))
    path = scratch_path(spark, "json-ledger")
    days.agg(F.to_json(stamps).alias("value")).coalesce(1).write.text(path)
    return ledgers.read_json_ledger(spark, path)


@query
def feature_files(spark, folder):
    # Features of a snapshot in files of the older layout, one per side.
    root, stamp = scratch_path(spark, "feature-files"), "20240101000000"
    parts = load(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    marked = sampling.split(parts, ["p_partkey"])
    for side in (sampling.TRAIN, sampling.TEST):
        rows = marked.where(F.col("split") == side).drop("split")
        csv.write_csv(rows, f"{root}/{stamp}_x_{side}.csv")
    return snapshots.read_feature_files(spark, root, stamp, parts.schema)


@query
def ledger_folded(spark, folder):
    # The orders of each month as a record of a ledger that four writers share and that is folded often.
    months = (
        load(spark, folder, "orders")
        .groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"), r6(F.avg("o_totalprice")).alias("mean_price"))
        .collect()  # one row per month
    )
    schema = "seq bigint, month string, n bigint, mean_price double"
    ledger = ledgers.Ledger(spark, scratch_path(spark, "ledger"), schema, fold_every=5)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda row: ledger.append(**row.asDict()), months))
    every = ledger.read()
    n_seq, last = every.agg(F.count_distinct("seq"), F.max("seq")).first()
    return every.select(
        "month", "n", "mean_price", F.lit(n_seq).alias("n_seq"), F.lit(last).alias("last_seq")
    )


@query
def snapshot_publish(spark, folder):
    # Three jobs of one second: two publish the orders of a status, one dies after its table.
    registry = Registry(spark, scratch_path(spark, "registry"))
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for status in ("F", "P", "O"):
        rows = sampling.split(orders.where(F.col("o_orderstatus") == status), ["o_orderkey"])
        snapshot_id = registry.reserve()
        snapshots.write_snapshot(rows, registry.snapshot_root, snapshot_id)
        if status != "P":
            path = snapshots.snapshot_path(registry.snapshot_root, snapshot_id)
            registry.publish(snapshot_id, rows.count(), table_path=path)
    swept = registry.sweep(older_than=0)
    found = []
    for row in registry.snapshots.read().collect():  # the two manifests
        table = snapshots.read_snapshot(spark, registry.snapshot_root, row["snapshot_id"])
        seen = table.groupBy("o_orderstatus", "split").agg(
            F.count(F.lit(1)).alias("n"), r6(F.sum("o_totalprice")).alias("total")
        )
        found.append(
            seen.withColumns(
                {"seq": F.lit(row["seq"]), "n_rows": F.lit(row["n_rows"]), "n_swept": F.lit(len(swept))}
            )
        )
    return reduce(DataFrame.unionByName, found)


@query
def latest_record(spark, folder):
    events = load(spark, folder, "events")
    return ledgers.latest_per_group(
        events, ["event_type"], "event_id", ["user_id", "ts", "value"]
    )


@query
def row_counts(spark, folder):
    counts = None
    for name in TABLES:
        one = load(spark, folder, name).agg(F.count(F.lit(1)).alias("n"))
        one = one.select(F.lit(name).alias("table_name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


# --- projections and filters ------------------------------------------------


@query
def drop_columns(spark, folder):
    return clean.drop_columns(load(spark, folder, "customer"), ["c_name", "no_such_column"])


@query
def lenient_cast(spark, folder):
    return clean.cast_to_double(dirty_orders(spark, folder), ["amount"])


@query
def drop_null_rows(spark, folder):
    cast = clean.cast_to_double(dirty_orders(spark, folder), ["amount"])
    nan = F.when(F.col("o_orderstatus") == "P", F.lit("NaN").cast("double")).otherwise(F.lit(1.5))
    return clean.drop_incomplete(cast.withColumn("rate", nan))


@query
def dedup_rows(spark, folder):
    lines = load(spark, folder, "lineitem")
    return clean.drop_duplicates(
        lines.select("l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    )


@query
def clean_losses(spark, folder):
    # What cleaning loses at each step, counted by the pass that writes its result.
    spec = FeatureSpec(label="o_orderstatus", drop=["o_orderkey"], to_double=["amount"])
    losses = clean.Losses()
    stage(clean.clean(dirty_orders(spark, folder), spec, losses), "cleaned")
    return losses.table(spark)


@query
def dedup_by_digest(spark, folder):
    # Orders with every tenth twice: only rows whose digest occurs again are compared whole.
    orders = load(spark, folder, "orders")
    again = orders.where(F.col("o_orderkey") % 10 == 0)
    return clean.drop_duplicates(orders.unionAll(again), by_digest=True)


@query
def clean_table(spark, folder):
    spec = FeatureSpec(label="o_orderstatus", drop=["o_orderkey", "gone"], to_double=["amount"])
    return clean.clean(dirty_orders(spark, folder), spec)


@query
def roles_of_columns(spark, folder):
    lines = load(spark, folder, "lineitem")
    numeric, categorical = column_roles(lines)
    one_row = lines.agg(*[F.count(c).alias(c) for c in lines.columns])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit("numeric" if c in numeric else "categorical").alias("role"),
            F.col(c).alias("n_values"),
        )
        for c in [*numeric, *categorical]
    ]
    return one_row.select(F.inline(F.array(*rows)))


@query
def select_by_name(spark, folder):
    customers = load(spark, folder, "customer").withColumns(
        {
            "a_scaled": F.col("c_nationkey") * 2,
            "b_indexed": F.col("c_nationkey") * 3,
            "c_encoded": F.col("c_nationkey") * 4,
        }
    )
    return clean.select_features(customers, also=["c_custkey"])


@query
def class_filter(spark, folder):
    return load(spark, folder, "labels").where(F.col("quality") == 0)


@query
def feature_columns_only(spark, folder):
    return clean.split_label(load(spark, folder, "labels"), "quality")[0]


@query
def label_column_only(spark, folder):
    label = clean.split_label(load(spark, folder, "labels"), "quality")[1]
    return label.groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@query
def derived_columns(spark, folder):
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = load(spark, folder, "lineitem").withColumns(
        {"revenue": r6(revenue), "charge": r6(revenue * (1 + F.col("l_tax")))}
    )
    return lines.select(*LINE_KEY, "revenue", "charge")


# --- feature transforms -----------------------------------------------------


@query
def numeric_stats(spark, folder):
    lines = load(spark, folder, "lineitem")
    stats = scaling.numeric_stats(lines, column_roles(lines, exclude=LINE_KEY[:3])[0])
    return stats.select("feature", "n", r6("mean").alias("mean"), r6("stddev").alias("stddev"))


@query
def zscore(spark, folder):
    customers = load(spark, folder, "customer")
    fitted = scaling.fit_scaler(customers, ["c_nationkey", "c_acctbal"])
    return scaling.apply_scaler(customers, fitted).select(
        "c_custkey",
        r6("c_nationkey_scaled").alias("c_nationkey_scaled"),
        r6("c_acctbal_scaled").alias("c_acctbal_scaled"),
    )


@query
def zscore_parts(spark, folder):
    parts = load(spark, folder, "part")
    numeric = column_roles(parts, exclude=["p_partkey"])[0]
    scaled = scaling.apply_scaler(parts, scaling.fit_scaler(parts, numeric))
    return scaled.select("p_partkey", *[r6(f"{c}_scaled").alias(f"{c}_scaled") for c in numeric])


@query
def zscore_constant(spark, folder):
    customers = load(spark, folder, "customer").withColumn("fixed", F.lit(7.25))
    fitted = scaling.fit_scaler(customers, ["fixed"])
    return scaling.apply_scaler(customers, fitted).select("c_custkey", "fixed_scaled")


@query
def category_frequency(spark, folder):
    return categories.category_counts(
        load(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"]
    )


@query
def category_map(spark, folder):
    orders = load(spark, folder, "orders")
    top = categories.top_categories(orders, ["o_orderstatus", "o_orderpriority"], 100)
    return top.select("feature", "value", "n", "index")


@query
def category_map_any_size(spark, folder):
    return categories.rank_categories(load(spark, folder, "orders"), "o_custkey")


@query
def category_index(spark, folder):
    orders = load(spark, folder, "orders")
    columns = ["o_orderstatus", "o_orderpriority"]
    indexed = categories.apply_index(orders, categories.fit_index(orders, columns), "error")
    return indexed.select("o_orderkey", *[f"{c}_indexed" for c in columns])


@query
def category_index_long_list(spark, folder):
    parts = load(spark, folder, "part")
    fitted = categories.fit_index(parts, ["p_name", "p_brand"])
    indexed = categories.apply_index(parts, fitted)
    return indexed.select("p_partkey", "p_name_indexed", "p_brand_indexed")


@query
def category_index_unseen(spark, folder):
    orders = load(spark, folder, "orders").withColumn(
        "cohort", F.date_format("o_orderdate", "yyyy-MM")
    )
    known = orders.where(F.col("o_orderdate") < moment("1998-01-01"))
    indexed = categories.apply_index(orders, categories.fit_index(known, ["cohort"]), "keep")
    return indexed.select("o_orderkey", "cohort_indexed")


@query
def category_index_wide(spark, folder):
    orders = load(spark, folder, "orders")
    columns = ["o_custkey", "o_totalprice", "o_orderstatus"]  # the first two are wide
    fitted = categories.fit_index(orders, columns, max_categories=50)
    indexed = categories.apply_index(orders, fitted)
    return indexed.select("o_orderkey", *[f"{c}_indexed" for c in columns])


@query
def features_of_other_table(spark, folder):
    # Scaling and categories learnt on one part of a table, applied to all of it.
    orders = load(spark, folder, "orders")
    known = orders.where(F.col("o_orderpriority") != "1-URGENT")
    state = fit_state(known, ["o_totalprice"], ["o_orderpriority"])
    features = to_features(orders, state, "keep")
    return features.select(
        "o_orderkey", r6("o_totalprice_scaled").alias("price"), "o_orderpriority_indexed"
    )


@query
def category_index_hot_unseen(spark, folder):
    # A column of many values, of which two rows in five have one that was not there when fitting.
    lines = load(spark, folder, "lineitem").select("l_partkey", "l_quantity")
    index = categories.fit_index(lines, ["l_partkey"], max_categories=100)
    new = F.when(F.col("l_quantity") <= 20, "new").otherwise(F.col("l_partkey").cast("string"))
    found = categories.apply_index(lines.withColumn("l_partkey", new), index)
    return found.groupBy("l_partkey_indexed").agg(F.count(F.lit(1)).alias("n"))


@query
def one_hot(spark, folder):
    customers = load(spark, folder, "customer")
    fitted = categories.fit_index(customers, ["c_mktsegment"])
    indexed = categories.apply_index(customers, fitted, "error")
    encoded, _ = categories.one_hot(indexed, fitted.sizes())
    dense = encoded.withColumn("v", vector_to_array("c_mktsegment_encoded"))
    slots = range(fitted.sizes()["c_mktsegment"] - 1)
    return dense.select("c_custkey", *[F.col("v")[i].alias(f"oh_{i}") for i in slots])


def _line_features(spark, folder):
    lines = load(spark, folder, "lineitem")
    numeric, categorical = DRIFT_COLUMNS, ["l_returnflag", "l_linestatus"]
    scaled = scaling.apply_scaler(lines, scaling.fit_scaler(lines, numeric))
    return categories.apply_index(scaled, categories.fit_index(lines, categorical), "error")


@query
def feature_matrix(spark, folder):
    features = clean.select_features(_line_features(spark, folder), also=LINE_KEY)
    return features.select(
        *LINE_KEY, *[r6(c).alias(c) for c in features.columns if c not in LINE_KEY]
    )


@query
def feature_vector(spark, folder):
    lines = _line_features(spark, folder)
    columns = ["l_quantity_scaled", "l_discount_scaled", "l_returnflag_indexed"]
    vectors = models.assembler(columns).transform(lines)
    dense = vectors.withColumn("v", vector_to_array(models.FEATURES))
    return dense.select(*LINE_KEY, *[r6(F.col("v")[i]).alias(f"v{i}") for i in range(3)])


def _rounded(prepared) -> DataFrame:
    table = prepared.table
    numbers = [c for c in table.columns if c.endswith(("_scaled", "_indexed"))]
    copy_no = F.col("copy_no").cast("bigint").alias("copy_no")
    return table.select("split", copy_no, *[r6(c).alias(c) for c in numbers])


@query
def prepare_split_first(spark, folder):
    return _rounded(prepare(labelled_documents(spark, folder), QUALITY))


@query
def prepare_balance_first(spark, folder):
    return _rounded(prepare(labelled_documents(spark, folder), QUALITY, order="balance_first"))


# --- sampling, balancing, splitting -----------------------------------------


@query
def class_counts(spark, folder):
    return sampling.class_counts(load(spark, folder, "labels"), "quality")


@query
def balance_minority(spark, folder):
    return sampling.balance(load(spark, folder, "labels"), "quality", ["doc_id"])


@query
def balance_every_class(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.balance(orders, "o_orderstatus", ["o_orderkey"], copy_column="copy_no")


@query
def balance_poisson(spark, folder):
    # Copies of each row by its own Poisson draw, whatever the partitions.
    labels = load(spark, folder, "labels").select("doc_id", "quality").repartition(7)
    sampled = sampling.balance_by_sampling(labels, "quality", seed=42, key=["doc_id"])
    return sampled.groupBy("doc_id", "quality").agg(F.count(F.lit(1)).alias("n_copies"))


@query
def balance_by_sampling(spark, folder):
    # What holds for any draw: rows of the largest class kept once, no unknown row, sizes near.
    labels = load(spark, folder, "labels")
    sampled = sampling.balance_by_sampling(labels, "quality", seed=42)
    size, largest = F.col("n_sampled"), F.max("n").over(Window.partitionBy())
    before = sampling.class_counts(labels, "quality")
    known = sampled.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")
    after = known.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n_sampled"), F.count_distinct("doc_id").alias("n_rows")
    )
    total = sampled.groupBy("quality").agg(F.count(F.lit(1)).alias("n_total"))
    facts = before.join(after, "quality").join(total, "quality").withColumn("top", largest)
    # Five standard deviations of a Poisson draw.
    near = F.abs(size - F.col("top")) <= 5 * F.sqrt(F.col("top"))
    whole = (F.col("n") < F.col("top")) | ((size == F.col("n")) & (F.col("n_rows") == F.col("n")))
    return facts.select(
        "quality",
        "n",
        near.alias("size_is_near"),
        whole.alias("largest_is_whole"),
        (F.col("n_total") == size).alias("only_known_rows"),
    )


@query
def split_hash(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey")
    return sampling.split(orders, ["o_orderkey"])


@query
def split_exact(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey")
    return sampling.split_exact(orders, ["o_orderkey"])


@query
def split_random_whole(spark, folder):
    train, test = sampling.split_random(load(spark, folder, "orders"))
    return sampling.merge_splits(train, test)


@query
def split_random_facts(spark, folder):
    # What holds for any draw: a share near the one asked for, sides disjoint, a draw that repeats.
    orders = load(spark, folder, "orders").select("o_orderkey")
    train, test = sampling.split_random(orders)
    again = sampling.split_random(orders)[1].withColumnRenamed("o_orderkey", "again")
    n, n_test = orders.agg(F.count(F.lit(1)).alias("n")), test.agg(F.count(F.lit(1)).alias("n_test"))
    both = train.join(test, "o_orderkey").agg(F.count(F.lit(1)).alias("n_both"))
    apart = test.join(again, F.col("o_orderkey") == F.col("again"), "full").where(
        "o_orderkey is null or again is null"
    )
    facts = n.join(n_test).join(both).join(apart.agg(F.count(F.lit(1)).alias("n_apart")))
    # Five standard deviations of the number of test rows.
    near = F.abs(F.col("n_test") - 0.2 * F.col("n")) <= 5 * F.sqrt(0.16 * F.col("n"))
    return facts.select("n", near.alias("share_is_near"), "n_both", "n_apart")


@query
def merge_splits(spark, folder):
    marked = sampling.split(load(spark, folder, "orders"), ["o_orderkey"])
    train = marked.where(F.col("split") == sampling.TRAIN).drop("split")
    test = marked.where(F.col("split") == sampling.TEST).drop("split")
    return sampling.merge_splits(train, test)


# --- ordering and choosing --------------------------------------------------


def _recency():
    return [F.col("ts").desc(), F.col("event_id").desc()]


@query
def recent_k(spark, folder):
    return ledgers.recent(load(spark, folder, "events"), 20, _recency())


@query
def recent_k_per_group(spark, folder):
    return ledgers.recent(load(spark, folder, "events"), 3, _recency(), ["user_id"])


@query
def champion(spark, folder):
    events = load(spark, folder, "events")
    return ledgers.champions(events, F.col("value"), _recency(), 10)


@query
def champion_per_group(spark, folder):
    # The value is missing for errors, which then count as 0.
    value = F.when(F.col("event_type") != "error", F.col("value"))
    events = load(spark, folder, "events").withColumn("metric", value)
    return ledgers.champions(events, F.col("metric"), _recency(), 2, ["user_id"])


# --- histograms and drift ---------------------------------------------------


@query
def feature_ranges(spark, folder):
    return histograms.range_table(load(spark, folder, "lineitem"), [*DRIFT_COLUMNS, "l_tax"])


@query
def histogram_fixed(spark, folder):
    lines = load(spark, folder, "lineitem")
    ranges = histograms.feature_ranges(lines, [*DRIFT_COLUMNS, "l_tax"])
    return histograms.histogram(lines, ranges).select(
        "feature", F.col("bin").cast("bigint").alias("bin"), "n"
    )


@query
def histogram_partly_out_of_range(spark, folder):
    # Few values lie in most bins; the empty ones are part of the result.
    ranges = {"value": (5.0, 60.0)}
    counts = histograms.histogram(load(spark, folder, "events"), ranges, bins=25)
    return histograms.with_empty_bins(counts, 25).select(
        "feature", F.col("bin").cast("bigint").alias("bin"), "n"
    )


@query
def bin_densities(spark, folder):
    events = load(spark, folder, "events")
    counts = histograms.histogram(events, histograms.feature_ranges(events, ["value"]), bins=20)
    full = histograms.with_empty_bins(counts, 20)
    in_order = F.sort_array(F.collect_list(F.struct("bin", "n")))
    listed = full.groupBy("feature").agg(in_order.alias("c"))
    shares = drift.densities(F.col("c.n"))
    return listed.select("feature", F.posexplode(shares).alias("bin", "density")).select(
        "feature", F.col("bin").cast("bigint").alias("bin"), F.round("density", 12).alias("density")
    )


def _psi_columns(table: DataFrame) -> DataFrame:
    return table.withColumn("psi", r6("psi"))


def _psi_only(table: DataFrame) -> DataFrame:
    return _psi_columns(table).drop("status")


@query
def psi_baseline(spark, folder):
    return _psi_only(drift.psi_by_side(lines_by_side(spark, folder), DRIFT_COLUMNS))


@query
def psi_combined(spark, folder):
    table = drift.psi_by_side(lines_by_side(spark, folder), DRIFT_COLUMNS, combined_range=True)
    return _psi_only(table)


def _events_by_side(spark, folder):
    side = F.when(F.col("ts") < moment(EVENT_SPLIT), "base").otherwise("new")
    return load(spark, folder, "events").select("value", side.alias("side"))


@query
def psi_events(spark, folder):
    return _psi_only(drift.psi_by_side(_events_by_side(spark, folder), ["value"], bins=20))


@query
def psi_constant_baseline(spark, folder):
    # The baseline knows one value only; new rows equal to it fill the last bin.
    steady = F.when(F.col("side") == "base", 3.0).otherwise(F.round("value"))
    tagged = _events_by_side(spark, folder).withColumn("value", steady)
    return _psi_only(drift.psi_by_side(tagged, ["value"]))


@query
def psi_out_of_range(spark, folder):
    far = F.when(F.col("side") == "base", F.col("value")).otherwise(F.col("value") + 1e6)
    tagged = _events_by_side(spark, folder).withColumn("value", far)
    return _psi_only(drift.psi_by_side(tagged, ["value"]))


@query
def psi_from_profile(spark, folder):
    early, late = lines_halves(spark, folder)
    path = scratch_path(spark, "profile")
    drift.profile(early, DRIFT_COLUMNS).write.parquet(path)
    return _psi_only(drift.psi_against_profile(spark.read.parquet(path), late))


@query
def psi_from_fine_profile(spark, folder):
    # The number of bins comes with the profile.
    early, late = lines_halves(spark, folder)
    path = scratch_path(spark, "profile")
    drift.profile(early, DRIFT_COLUMNS, bins=20).write.parquet(path)
    return _psi_only(drift.psi_against_profile(spark.read.parquet(path), late))


def _halves_with_gaps(spark, folder):
    """The halves, ``l_tax`` without a value in the old one, ``l_discount`` in the new one."""
    early, late = lines_halves(spark, folder)
    nothing = F.lit(None).cast("double")
    late = late.withColumn("l_tax", F.col("l_quantity"))
    return early.withColumn("l_tax", nothing), late.withColumn("l_discount", nothing)


@query
def drift_report_gaps(spark, folder):
    early, late = _halves_with_gaps(spark, folder)
    return _psi_columns(drift.drift_report(early, late))


@query
def drift_gate_halt(spark, folder):
    early, late = _halves_with_gaps(spark, folder)
    return drift.retrain_gate(drift.drift_report(early, late)).withColumn("max_psi", r6("max_psi"))


@query
def drift_gate_new_feature(spark, folder):
    # A feature the baseline has no values of, from a stored profile; nothing else has moved.
    early, _ = lines_halves(spark, folder)
    steady = early.select("l_quantity", "l_discount", "l_tax")
    path = scratch_path(spark, "profile")
    drift.profile(
        steady.withColumn("l_tax", F.lit(None).cast("double")), steady.columns
    ).write.parquet(path)
    report = drift.drift_report_from_profile(spark.read.parquet(path), steady)
    return drift.retrain_gate(report).withColumn("max_psi", r6("max_psi"))


@query
def drift_report(spark, folder):
    early, late = lines_halves(spark, folder)
    return _psi_columns(drift.drift_report(early.drop("l_tax"), late))


@query
def drift_report_missing_feature(spark, folder):
    early, late = lines_halves(spark, folder)
    return _psi_columns(drift.drift_report(early, late))


@query
def drift_gate(spark, folder):
    early, late = lines_halves(spark, folder)
    gate = drift.retrain_gate(drift.drift_report(early.drop("l_tax"), late))
    return gate.withColumn("max_psi", r6("max_psi"))


@query
def drift_report_combined(spark, folder):
    # Bins over both sides also catch a column that has left its old range altogether.
    early, late = lines_halves(spark, folder)
    report = drift.drift_report(early.drop("l_tax"), late, combined_range=True)
    return _psi_columns(report)


@query
def drift_gate_combined(spark, folder):
    early, late = lines_halves(spark, folder)
    report = drift.drift_report(early.drop("l_tax"), late, combined_range=True)
    return drift.retrain_gate(report).withColumn("max_psi", r6("max_psi"))


@query
def drift_gate_stable(spark, folder):
    tagged = lines_by_side(spark, folder)
    gate = drift.retrain_gate(drift.flag(drift.psi_by_side(tagged, DRIFT_COLUMNS)))
    return gate.withColumn("max_psi", r6("max_psi"))


@query
def inject_shift(spark, folder):
    lines = load(spark, folder, "lineitem")
    shifted = drift.inject_shift(lines, "l_quantity", "l_extendedprice", key=LINE_KEY)
    return shifted.select(*LINE_KEY, r6("l_extendedprice").alias("l_extendedprice"))


@query
def inject_shift_random(spark, folder):
    # What holds for any draw: noise of mean 0 and deviation 1, within five standard errors.
    lines = load(spark, folder, "lineitem")
    shifted = drift.inject_shift(lines, "l_quantity", "l_extendedprice", seed=7)
    noise = F.col("l_extendedprice") - F.col("l_quantity") * 1.5
    facts = shifted.agg(
        F.count(F.lit(1)).alias("n"), F.avg(noise).alias("m"), F.stddev_samp(noise).alias("s")
    )
    error = 5 / F.sqrt(F.col("n").cast("double"))
    return facts.select(
        "n",
        (F.abs("m") < error).alias("mean_is_near"),
        (F.abs(F.col("s") - 1) < error).alias("deviation_is_near"),
    )


@query
def psi_from_summary(spark, folder):
    # The combined range from a summary of the baseline: as near to the exact PSI as it says.
    lines = lines_by_side(spark, folder)
    base, new = (lines.where(F.col("side") == side).drop("side") for side in (drift.BASE, drift.NEW))
    summary = summaries.summarize(base.select(*DRIFT_COLUMNS), DRIFT_COLUMNS)
    found = summaries.psi_against_summary(summary, new, combined_range=True)
    exact = drift.psi(base, new, DRIFT_COLUMNS, combined_range=True)
    return found.join(exact.select("feature", F.col("psi").alias("exact")), "feature").select(
        "feature",
        (F.abs(F.col("psi") - F.col("exact")) <= F.col("max_error") + 1e-12).alias("is_near"),
        (F.col("max_error") < 0.02).alias("error_is_small"),
        r6("exact").alias("exact"),
    )


@query
def drift_report_disjoint(spark, folder):
    # Tables that share no column: nothing to compare, and the gate halts.
    lines = load(spark, folder, "lineitem")
    report = drift.drift_report(lines.select("l_quantity", "l_tax"), lines.select("l_discount"))
    verdict = drift.retrain_gate(report).first()
    return report.select(
        "feature", "psi", "status",
        F.lit(verdict["decision"]).alias("decision"), F.lit(verdict["reason"]).alias("reason"),
    )


@query
def schema_diff(spark, folder):
    lines = load(spark, folder, "lineitem")
    base = lines.select("l_quantity", "l_tax", "l_linenumber")
    new = lines.select(
        "l_quantity", F.col("l_linenumber").cast("double").alias("l_linenumber"), "l_discount"
    )
    return drift.schema_report(base, new)


# --- quality ----------------------------------------------------------------


@query
def confusion(spark, folder):
    return metrics.confusion(ruled_lines(spark, folder), "label")


@query
def accuracy(spark, folder):
    table = metrics.accuracy(ruled_lines(spark, folder), "label")
    return table.withColumn("accuracy", r6("accuracy"))


@query
def class_metrics(spark, folder):
    table = metrics.class_metrics(metrics.confusion(ruled_lines(spark, folder), "label"))
    return table.select(
        "label", "support", *[r6(c).alias(c) for c in ("recall", "precision", "f1")]
    )


@query
def summary_metrics(spark, folder):
    table = metrics.summary_metrics(metrics.confusion(ruled_lines(spark, folder), "label"))
    return table.select(*[r6(c).alias(c) for c in models.METRICS])


# --- models -----------------------------------------------------------------


def _ruled_orders(spark, folder):
    """Orders labelled by a rule that a learner must find: the price is above ``PRICE_RULE``.

    Prices within ``PRICE_MARGIN`` of it, where learners may differ, are left out, and the
    price is given in steps, so that trees, which try 32 bins, can tell all of them apart.
    """
    price = F.col("o_totalprice")
    return (
        load(spark, folder, "orders")
        .where(F.abs(price - PRICE_RULE) > PRICE_MARGIN)
        .select(
            "o_orderkey",
            (F.floor(price / PRICE_STEP) * PRICE_STEP / PRICE_RULE - 1).alias("price"),
            F.when(price > PRICE_RULE, 1.0).otherwise(0.0).alias("label"),
        )
    )


def _train(algorithm: str) -> Query:
    def run(spark, folder):
        marked = sampling.split(_ruled_orders(spark, folder), ["o_orderkey"])
        train_side = marked.where(F.col("split") == sampling.TRAIN).select("price", "label").persist()
        model = models.train(train_side, "label", algorithm)
        train_side.unpersist()
        scored = models.score(model, _ruled_orders(spark, folder).drop("label"))
        return scored.select("o_orderkey", F.lit(algorithm).alias("algorithm"), "prediction")

    run.__name__ = f"train_{algorithm}"
    return run


for _algorithm in models.ALGORITHMS:
    query(_train(_algorithm))


@query
def score_resumed(spark, folder):
    # Four files, of which the first call scores two and the second the rest.
    rows = _ruled_orders(spark, folder)
    learnt = rows.select("price", "label")
    registry = Registry(spark, scratch_path(spark, "registry"))
    schema = models.input_schema(learnt, "label")
    model = models.train(learnt, "label", "logistic")
    run_id = registry.record_run(model, "20240101000000", "logistic", {"accuracy": 1.0}, schema)
    registry.promote(registry.run(run_id), "orders")
    source, target = scratch_path(spark, "to-score"), scratch_path(spark, "scored")
    rows.drop("label").repartition(4).write.parquet(source)
    for at_most in (2, None):
        lifecycle.score_new_files(registry, "orders", source, target, files_at_once=1, at_most=at_most)
    return lifecycle.read_scored(registry, "orders", target).select("o_orderkey", "prediction")


@query
def evaluate_model(spark, folder):
    # A model of the rule, judged by labels of which every tenth is turned round.
    rows = _ruled_orders(spark, folder)
    model = models.train(rows.select("price", "label"), "label", "tree")
    turned = F.when(F.col("o_orderkey") % 10 == 0, 1 - F.col("label")).otherwise(F.col("label"))
    quality = models.evaluate(model, rows.withColumn("label", turned), "label")
    return quality.select(*[r6(c).alias(c) for c in models.METRICS])


@query
def batch_score(spark, folder):
    rows = _ruled_orders(spark, folder)
    path = scratch_path(spark, "model")
    learnt = rows.select("price", "label")
    models.train(learnt, "label", "logistic").write().save(path)
    schema = models.input_schema(learnt, "label")
    return models.score(path, rows.drop("label"), schema).select("o_orderkey", "prediction")


@query
def run_and_promote(spark, folder):
    """Two rounds: no model yet, then an unchanged table, which is left alone."""
    registry = Registry(spark, scratch_path(spark, "registry"))
    table = labelled_documents(spark, folder)
    label = "quality_indexed"
    small = {"forest": {"numTrees": 20}}
    decisions = []
    for stamp in ("20240101000000", "20240102000000"):
        prepare_snapshot(registry, table, QUALITY, "quality", stamp)
        decision, reason = lifecycle.retrain_if_needed(
            registry, "quality", label, overrides=small
        )
        decisions.append((stamp, decision, reason))
    schema = "snapshot_id string, decision string, reason string"
    verdicts = spark.createDataFrame(decisions, schema)
    runs = registry.runs.read().groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("n_runs"))
    promoted = registry.promoted().select("snapshot_id", "version", "stage")
    return (
        registry.snapshots.read()
        .select("snapshot_id", "n_rows")
        .join(verdicts, "snapshot_id")
        .join(runs, "snapshot_id", "left")
        .join(promoted, "snapshot_id", "left")
    )
