"""The query catalog: one Spark plan per inventory entry, over the driver's tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame. Queries that
exercise file sources and sinks write to a fresh folder below the shared
checkpoint folder and return a frame that reads the written files back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import specs as S
from strata.functions import casts, text
from strata.operators import merge
from strata.plans import jobs, standins
from strata.plans.standins import table
from strata.session import released, work_dir
from strata.sinks import tables
from strata.sources import csv as csv_src
from strata.sources import layers
from strata.sources.multiline import read_multiline


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


# --- sources -----------------------------------------------------------------

def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (commas, quotes, newlines in text) -> CSV -> typed read."""
    docs = table(spark, sf_dir, "documents")
    path = csv_src.write_csv(docs, work_dir(spark, "csv_scan"))
    return csv_src.read_csv(spark, path, docs.schema, multiline=True)


def csv_parse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + P13: orders rendered as CSV text in a column, parsed back to typed rows."""
    o = table(spark, sf_dir, "orders")
    lines = o.select(text.render_csv(*o.columns).alias("line"))
    return lines.select(text.parse_csv("line", _ddl(o.schema)).alias("r")).select("r.*")


RAGGED_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])


def csv_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: short rows padded with null, long rows cut, both flagged as malformed."""
    c = table(spark, sf_dir, "customer")
    fields = [F.col("c_custkey").cast("string"), F.col("c_name"),
              F.col("c_nationkey").cast("string"),
              F.col("c_acctbal").cast("decimal(18,2)").cast("string"), F.col("c_mktsegment")]
    line = (F.when(F.col("c_custkey") % 5 == 0, F.concat_ws(",", *fields[:3]))
            .when(F.col("c_custkey") % 7 == 0, F.concat_ws(",", *fields, F.lit("extra")))
            .otherwise(F.concat_ws(",", *fields)))
    path = csv_src.write_text_lines(c.select(line.alias("line")), "line",
                                    work_dir(spark, "csv_ragged"))
    df = csv_src.read_csv(spark, path, RAGGED_SCHEMA, header=False,
                          corrupt_column=csv_src.CORRUPT)
    return df.select(*RAGGED_SCHEMA.names,
                     F.col(csv_src.CORRUPT).isNotNull().alias("malformed"))


def csv_scan_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (newlines in quoted text) as few large CSV files, each read in many splits."""
    docs = table(spark, sf_dir, "documents")
    path = csv_src.write_csv(docs, work_dir(spark, "csv_scan_splits"))
    return read_multiline(spark, path, docs.schema).select(*docs.columns)


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: short and long lines of a feed go to the reject table with their text and reason; the
    others are loaded."""
    spec = S.CUSTOMERS
    c = standins.feed(spark, sf_dir, spec)
    key = F.col("customer_id").cast("bigint")
    quoted = F.concat(F.lit('"'), F.col("customer_city"), F.lit(', ""x"""'))
    fields = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", quoted,
              F.coalesce("customer_state", F.lit(""))]
    line = (F.when(key % 5 == 0, F.concat_ws(",", *fields[:3]))
            .when(key % 7 == 0, F.concat_ws(",", *fields, F.lit("more, and more")))
            .otherwise(F.concat_ws(",", *fields)))
    root = work_dir(spark, "rejected_rows")
    landing = csv_src.write_text_lines(c.select(line.alias("line")), "line", f"{root}/landing")
    jobs.load_raw(spark, spec, landing, f"{root}/lake", on_malformed=jobs.REJECT, header=False)
    bad = spark.read.parquet(jobs.rejects_path(f"{root}/lake", spec))
    good = layers.read_layer(spark, jobs.table_path(f"{root}/lake", jobs.RAW, spec))
    return (bad.select("reason", F.col("load").cast("bigint").alias("load"), "line")
            .unionByName(good.select(F.lit("loaded").alias("reason"), F.lit(1).cast("bigint").alias("load"),
                                     F.concat_ws("|", *spec.columns).alias("line"))))


# --- union / upsert / dedupe -------------------------------------------------

def _drops(spark: SparkSession, sf_dir: str):
    """Snapshot = orders; drop A re-keys every order to 2k with a doubled price;
    drop B re-keys to 3k with status 'F'. Keys 6k are in both drops."""
    o = table(spark, sf_dir, "orders")
    a = o.withColumn("o_orderkey", F.col("o_orderkey") * 2) \
         .withColumn("o_totalprice", F.col("o_totalprice") * 2)
    b = o.withColumn("o_orderkey", F.col("o_orderkey") * 3) \
         .withColumn("o_orderstatus", F.lit("F"))
    return o, a, b


def union_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag union of the snapshot and a drop."""
    o, a, _ = _drops(spark, sf_dir)
    return merge.union_rows(o, a)


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot upserted with drops A then B (later drop wins)."""
    o, a, b = _drops(spark, sf_dir)
    batch = merge.union_rows(a.withColumn("seq", F.lit(1)), b.withColumn("seq", F.lit(2)))
    return merge.upsert(o, batch, "o_orderkey", order="seq")


def keep_last_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 with the reference key: one line item per order (last line number)."""
    li = table(spark, sf_dir, "lineitem")
    return merge.keep_last(li, "l_orderkey", order="l_linenumber")


def keep_last_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 with the natural key (order, line number); ties broken by the full row."""
    li = table(spark, sf_dir, "lineitem")
    return merge.keep_last(li, ["l_orderkey", "l_linenumber"])


def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: each user's first event by (ts, event_id)."""
    ev = table(spark, sf_dir, "events")
    return merge.first_per_key(ev, "user_id", order=["ts", "event_id"])


def group_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: conversation turns collected per conversation, in turn order."""
    conv = table(spark, sf_dir, "conversations")
    g = merge.group_rows(conv, "conv_id", "turn", block_size=1024)
    return g.select(
        "conv_id", "block",
        F.size("rows").cast("bigint").alias("n_turns"),
        F.col("rows")[0]["turn"].alias("first_turn"),
        F.element_at("rows", -1)["turn"].alias("last_turn"),
        F.array_join(F.transform("rows", lambda r: r["role"]), ",").alias("roles"),
        F.array_join(F.transform("rows", lambda r: r["text"]), "\n").alias("transcript"))


def group_rows_repeated_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 where an order value repeats thousands of times: lists keep their bound."""
    ev = table(spark, sf_dir, "events").select(
        "event_type", (F.col("event_id") % 10).alias("digit"), "event_id")
    g = merge.group_rows(ev, "event_type", "digit", block_size=256)
    return g.select("event_type", "block", "part", F.size("rows").cast("bigint").alias("n_rows"),
                    F.col("rows")[0]["event_id"].alias("first_event"),
                    F.element_at("rows", -1)["event_id"].alias("last_event"))


def sort_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: parts by name (nulls last, then full row), with their global position."""
    part = table(spark, sf_dir, "part")
    return merge.with_positions(merge.sort_rows(part, "p_name"))


# --- row expressions ---------------------------------------------------------

def cast_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero-padded text -> bigint, money text -> double, int -> text/double,
    and the spellings a number may have."""
    c = table(spark, sf_dir, "customer")
    padded = F.lpad(F.col("c_custkey").cast("string"), 10, "0")
    money = F.col("c_acctbal").cast("decimal(18,2)").cast("string")
    return c.select(
        "c_custkey",
        casts.cast_text(padded, "long").alias("key_long"),
        casts.cast_text(money, "double").alias("balance"),
        casts.cast_text(F.col("c_nationkey"), "string").alias("nation_text"),
        F.col("c_nationkey").cast("double").alias("nation_double"),
        casts.cast_text(spelled(), "double").alias("spelled"),
        casts.cast_text(F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" ")), "long")
        .alias("spaced_long"))


def spelled():
    """A number's text in one of the spellings that count, by the row's key."""
    k = F.col("c_custkey")
    return (F.when(k % 5 == 0, F.lit("1e3")).when(k % 5 == 1, F.lit("inf")).when(k % 5 == 2, F.lit(" 7 "))
            .when(k % 5 == 3, F.lit("-.5")).otherwise(F.lit("+4.")))


def _dirty_size():
    return (F.when(F.col("p_partkey") % 6 == 0, F.lit("abc"))
            .when(F.col("p_partkey") % 9 == 0, F.lit("4.7"))
            .when(F.col("p_partkey") % 15 == 1, F.lit("-2.9"))
            .when(F.col("p_partkey") % 15 == 2, F.lit("4d"))
            .when(F.col("p_partkey") % 15 == 4, F.lit("4f"))
            .when(F.col("p_partkey") % 15 == 5, F.lit(" 7 "))
            .when(F.col("p_partkey") % 15 == 7, F.lit("1e3"))
            .otherwise(F.col("p_size").cast("string")))


def coerce_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unparseable -> 0, decimals truncated toward zero."""
    p = table(spark, sf_dir, "part")
    s = p.select("p_partkey", _dirty_size().alias("size_text"))
    return s.select("p_partkey", "size_text", casts.coerce_long("size_text").alias("size_num"))


def fill_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls made by rule, then filled by type (0 / '0')."""
    c = table(spark, sf_dir, "customer")
    dirty = c.select(
        "c_custkey", "c_name",
        F.when(c.c_custkey % 7 != 0, c.c_nationkey).alias("c_nationkey"),
        F.when(c.c_custkey % 4 != 0, c.c_acctbal).alias("c_acctbal"),
        F.when(c.c_custkey % 5 != 0, c.c_mktsegment).alias("c_mktsegment"))
    return casts.fill_zero(dirty, exclude=["c_custkey"])


def replace_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks made by rule, replaced by '0'."""
    p = table(spark, sf_dir, "part")
    dirty = p.select(
        "p_partkey", "p_name",
        F.when(p.p_partkey % 3 == 0, F.lit("")).otherwise(p.p_brand).alias("p_brand"),
        F.when(p.p_partkey % 4 == 0, F.lit("")).otherwise(p.p_type).alias("p_type"))
    return casts.replace_blank(dirty, ["p_brand", "p_type"])


def date_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order timestamps as text ('' / 'None' / null tokens) -> dates."""
    o = standins.orders(spark, sf_dir)
    cols = [c for c in S.ORDERS.columns if c in S.ORDERS.dates]
    return o.select("order_id", *[casts.parse_date(c, S.STRICT).alias(c) for c in cols])


def date_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review dates with 'None' and free text -> dates or null."""
    r = standins.reviews(spark, sf_dir)
    return r.select("review_id",
                    *[casts.parse_date(c, S.TOLERANT).alias(c)
                      for c in ("review_creation_date", "review_answer_timestamp")])


def render_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as quoted CSV records and as bare comma-joined text."""
    d = table(spark, sf_dir, "documents")
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    return d.select("doc_id", text.render_csv(*cols, quote_all=True).alias("line"),
                    text.render_bare(*cols).alias("bare"))


def split_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bare text split on commas into a key and the remaining fields."""
    d = table(spark, sf_dir, "documents")
    bare = text.render_bare("doc_id", "text", "lang", "source", "n_chars")
    key, rest = text.split_key(bare)
    return d.select("doc_id", key.alias("key"),
                    F.size(rest).cast("bigint").alias("n_rest"),
                    F.array_join(rest, "|").alias("rest"))


def expand_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P16 + P14: each document as a list of lines (lists of words), one row per line."""
    d = table(spark, sf_dir, "documents")
    nested = d.select("doc_id", F.transform(F.split("text", "\n", -1),
                                            lambda ln: F.split(ln, " ", -1)).alias("joins"))
    flat = text.expand_lists(nested, "doc_id", "joins")
    return flat.select("doc_id", F.size("joins").cast("bigint").alias("n_words"),
                       text.render_joins("doc_id", "joins").alias("line"))


def render_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item as (order key, [part, supplier, line number]) -> 'k,p,s,n'."""
    li = table(spark, sf_dir, "lineitem")
    joined = li.select("l_orderkey", F.array(*[F.col(c).cast("string") for c in
                                              ("l_partkey", "l_suppkey", "l_linenumber")])
                       .alias("joins"))
    return joined.select("l_orderkey", text.render_joins("l_orderkey", "joins").alias("line"))


# --- typed projection per table (P2 / J3 plan) --------------------------------

def typed_projection(name: str):
    spec = S.SPECS[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = standins.feed(spark, sf_dir, spec)
        return jobs.refined_rows(casts.trusted_columns(raw, spec, casts.STRICT), spec)

    q.__name__ = f"typed_projection_{name}"
    q.__doc__ = f"P2: {name} stand-in feed -> trusted casts -> refined types."
    return q


# --- sinks -----------------------------------------------------------------

def _publish_twice(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    rows = typed_projection("customers")(spark, sf_dir)
    path = work_dir(spark, f"publish_{mode}")
    tables.publish(rows, mode, path=path)
    tables.publish(rows, mode, path=path)
    return spark.read.parquet(path)


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 append: the same rows published twice are there twice."""
    return _publish_twice(spark, sf_dir, tables.APPEND)


def overwrite_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 overwrite: a rerun replaces, so the rows are there once."""
    return _publish_twice(spark, sf_dir, tables.OVERWRITE)


# --- composite jobs ----------------------------------------------------------

def packing(spec: S.TableSpec) -> str:
    """How a large drop lands: as gzip files, each read by one task, but for a multiline feed, whose
    files are read in splits."""
    return "none" if spec.multiline else "gzip"


def land_feeds(spark: SparkSession, sf_dir: str, landing: str, skip=(),
               parallelism: int = 8) -> None:
    """Write each stand-in feed as CSV at ``<landing>/<source file>`` (concurrent jobs)."""
    from concurrent.futures import ThreadPoolExecutor

    todo = [s for s in S.ALL_SPECS if s.name not in skip]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        list(pool.map(lambda spec: csv_src.write_csv(standins.feed(spark, sf_dir, spec),
                                                     f"{landing}/{spec.source_file}",
                                                     compression=packing(spec)), todo))


def layer_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1-J4 + K4: full run over all stand-ins; geolocation's file is missing."""
    root = work_dir(spark, "layer_run")
    landing, base = f"{root}/landing", f"{root}/lake"
    land_feeds(spark, sf_dir, landing, skip=("geolocation",))
    result = jobs.run_all(spark, landing, base)
    layers.delete_path(spark, root)      # the log is held in the session, not in files
    return result.log.select("layer", "table_name", "status", "rows")


def layer_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 again over the same landing files, onto the lake the first run left.

    The feeds are full re-deliveries, so every raw and trusted step takes the merge
    path against an existing version (keys-only shuffle, nothing orphaned) and
    the refined step appends again. The log of the second run is returned.
    """
    root = work_dir(spark, "layer_rerun")
    landing, base = f"{root}/landing", f"{root}/lake"
    land_feeds(spark, sf_dir, landing, skip=("geolocation",))
    jobs.run_all(spark, landing, base, full_snapshot=True)
    result = jobs.run_all(spark, landing, base, full_snapshot=True)
    layers.delete_path(spark, root)
    return result.log.select("layer", "table_name", "status", "rows")


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot and two drops land as CSV files; a stream upserts each in turn."""
    from strata.streaming.incremental import incremental_load as run_stream

    root = work_dir(spark, "incremental_load")
    landing, target = f"{root}/landing", f"{root}/orders"
    o, a, b = _drops(spark, sf_dir)
    ckpt = f"{root}/_checkpoint"
    # first trigger: the snapshot has landed; second trigger: drops A then B landed
    csv_src.write_csv(o, landing, mode="append")
    run_stream(spark, landing, target, o.schema, key=["o_orderkey"], checkpoint=ckpt)
    for drop in (a, b):          # each drop is one write job, in arrival order
        csv_src.write_csv(drop, landing, mode="append")
    run_stream(spark, landing, target, o.schema, key=["o_orderkey"], checkpoint=ckpt)
    for done in (landing, ckpt):
        layers.delete_path(spark, done)  # the result reads the newest version only
    return layers.read_layer(spark, target)


def refined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum slice: the orders feed lands as CSV, then raw -> trusted -> refined."""
    root = work_dir(spark, "refined_orders")
    landing, base = f"{root}/landing", f"{root}/lake"
    spec = S.ORDERS
    csv_src.write_csv(standins.feed(spark, sf_dir, spec), f"{landing}/{spec.source_file}")
    jobs.load_raw(spark, spec, f"{landing}/{spec.source_file}", base, stage=True)   # K2 stage
    jobs.load_trusted(spark, spec, base, raw_unique=True)   # raw was just written, same key
    jobs.load_refined(spark, spec, base, write_mode=tables.OVERWRITE)
    for done in (landing, jobs.table_path(base, jobs.RAW, spec),
                 jobs.table_path(base, jobs.TRUSTED, spec)):
        layers.delete_path(spark, done)  # the result reads the refined table only
    return spark.read.parquet(jobs.table_path(base, jobs.REFINED, spec))


# --- contents of the loads -----------------------------------------------------

# The text column that the second drop of each feed changes.
MARKED = {"customers": "customer_city", "geolocation": "geolocation_city", "items": "product_id",
          "orders": "order_status", "payments": "payment_type", "products": "product_category_name",
          "reviews": "review_comment_title", "sellers": "seller_city"}


def second_drop(feed: DataFrame, spec: S.TableSpec) -> DataFrame:
    """The whole feed again with its first column doubled (unpadded) and a column marked: some
    keys are in the first drop too, and most of the first drop's are not in this one."""
    first = spec.columns[0]
    return feed.select(*[
        (F.col(c).cast("bigint") * 2).cast("string").alias(c) if c == first
        else F.concat(F.col(c), F.lit("*")).alias(c) if c == MARKED[spec.name]
        else F.col(c) for c in spec.columns])


def land_in_order(df: DataFrame, keys: list[str], path: str, compression: str = "none") -> str:
    """A landing drop in which all rows of a key are in one file, the smallest row last."""
    placed = _by_key(df, keys).sortWithinPartitions(*[F.col(c).desc_nulls_last() for c in df.columns])
    return csv_src.write_csv(placed, path, compression=compression)


def _by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by key, in partitions that a task can sort."""
    return layers.deal(df, keys, 1, _volume(df))


def _volume(df: DataFrame) -> int:
    spark = df.sparkSession
    return layers.memory_bytes(df, df.count(), layers.size_of(spark, df.inputFiles()))


def dealt_feed(spark: SparkSession, sf_dir: str, spec: S.TableSpec, keys: list[str]) -> DataFrame:
    """As ``_by_key`` deals a feed; the table's rows cross the shuffle, and become texts after it."""
    parts = layers.parts_of(spark, _volume(standins.feed(spark, sf_dir, spec)))

    def arrange(rows, columns):
        by = [columns[k] for k in keys]
        return rows.repartition(parts, *by) if parts else rows.repartition(*by)

    return standins.feed(spark, sf_dir, spec, arrange)


def land_two_drops(dealt: DataFrame, spec: S.TableSpec, path: str) -> list[str]:
    """A feed that is dealt by key and its ``second_drop``, each as ``land_in_order`` lands it. They are dealt in
    one shuffle: rows that share a key in the one drop share it in the other."""
    both = dealt.withColumn("drop", F.lit(0)).unionByName(second_drop(dealt, spec).withColumn("drop", F.lit(1)))
    placed = both.sortWithinPartitions("drop", *[F.col(c).desc_nulls_last() for c in dealt.columns])
    with released(dealt.sparkSession):
        csv_src.write_csv(placed, path, compression=packing(spec), by=("drop",))
    return [f"{path}/drop={n}" for n in (0, 1)]


def loaded(name: str, key: str = "natural", bucket_bytes: int = tables.BUCKET_BYTES):
    """Two overlapping drops through the three layers; the refined rows."""
    spec = S.SPECS[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_dir(spark, f"loaded_{name}")
        base = f"{root}/lake"
        feed = dealt_feed(spark, sf_dir, spec, spec.keys(natural=key == "natural"))
        for landing in land_two_drops(feed, spec, f"{root}/landing"):
            jobs.load_raw(spark, spec, landing, base, key=key, bucket_bytes=bucket_bytes)
            jobs.load_trusted(spark, spec, base, key=key, raw_unique=True, bucket_bytes=bucket_bytes)
            jobs.load_refined(spark, spec, base, write_mode=tables.OVERWRITE)
            layers.delete_path(spark, landing)
        return spark.read.parquet(jobs.table_path(base, jobs.REFINED, spec))

    q.__name__ = f"loaded_{name}" if key == "natural" else f"loaded_{name}_{key}"
    q.__doc__ = f"J1-J3: {name} by its {key} key, contents after two overlapping loads."
    return q


def loaded_in_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1-J3 of a table in hash buckets: the second load writes the buckets that it meets."""
    return loaded("customers", bucket_bytes=1 << 14)(spark, sf_dir)


def sorted_files_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 in files: refined orders in files of disjoint key ranges. Rows, and how many files have a
    key that is not above all keys of the file before."""
    spec = S.ORDERS
    root = work_dir(spark, "sorted_files_orders")
    base = f"{root}/lake"
    landing = csv_src.write_csv(standins.feed(spark, sf_dir, spec), f"{root}/landing")
    jobs.load_raw(spark, spec, landing, base)
    jobs.load_trusted(spark, spec, base, raw_unique=True)
    jobs.load_refined(spark, spec, base, write_mode=tables.OVERWRITE, sort_files=True)
    refined = spark.read.parquet(jobs.table_path(base, jobs.REFINED, spec))
    files = refined.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min("order_id").alias("low"), F.max("order_id").alias("high"))
    # one row for each file
    above = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    return (files.select("n", (F.col("low") <= above).alias("meets"))
            .agg(F.sum("n").alias("orders"), F.count(F.when(F.col("meets"), 1)).alias("files_that_meet")))


def published_catalog_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3/J3 to a catalog table: an append, an overwrite by switching the table to a complete
    folder, and an overwrite that fails. A reader that began before the switch ends with its rows;
    the rows it read and the table's rows now, by order status."""
    spec = S.ORDERS
    root = work_dir(spark, "published_catalog_orders")
    name, path = f"strata_{root.rsplit('-', 1)[-1]}", f"{root}/orders"
    feed = standins.feed(spark, sf_dir, spec)
    first, second = (jobs.refined_rows(casts.trusted_columns(f, spec, casts.STRICT), spec)
                     for f in (feed, second_drop(feed, spec)))
    tables.publish(first, tables.APPEND, table=name, path=path, schema=spec.refined_schema)
    before = spark.table(name)
    tables.publish(second, tables.OVERWRITE, table=name, path=path, schema=spec.refined_schema)
    bad = second.withColumn("order_approved_at", F.when(F.col("order_id") != "", F.raise_error(F.lit("bad"))
                                                        .cast("date")))
    try:
        tables.publish(bad, tables.OVERWRITE, table=name, path=path)
    except Exception:  # noqa: BLE001 - it has to fail; the rows below show what it left
        pass
    else:
        raise RuntimeError("the overwrite has to fail")

    def counts(df: DataFrame, when: str) -> DataFrame:
        return df.groupBy("order_status").agg(
            F.count(F.lit(1)).alias("orders"), F.sum(F.col("order_id").cast("long")).alias("id_sum"),
            F.max("order_purchase_timestamp").alias("latest")).select(F.lit(when).alias("read"), "*")

    return counts(before, "before").unionByName(counts(spark.table(name), "now"))


def raw_in_file_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of an order's lines in one file the one that comes last stays, here the smallest."""
    spec = S.ITEMS
    root = work_dir(spark, "raw_in_file_last")
    landing = land_in_order(standins.feed(spark, sf_dir, spec), ["order_id"], f"{root}/landing", packing(spec))
    jobs.load_raw(spark, spec, landing, f"{root}/lake", key="reference")
    return layers.read_layer(spark, jobs.table_path(f"{root}/lake", jobs.RAW, spec)).select(*spec.columns)


def trusted_zip_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prefix with and without leading zeros in one file is one key; the later row stays."""
    spec = S.GEOLOCATION
    root = work_dir(spark, "trusted_zip_variants")
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("k"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("lat"), F.col("c_name").alias("city"))
    both = c.withColumn("v", F.explode(F.array(F.lit(1), F.lit(2))))
    rows = both.repartition("k").sortWithinPartitions("k", "v").select(
        F.when(F.col("v") == 1, F.lpad("k", 12, "0")).otherwise(F.col("k")).alias(spec.columns[0]),
        F.col("lat").alias(spec.columns[1]), F.lit("1").alias(spec.columns[2]),
        # the earlier row is the greater text
        F.concat(F.when(F.col("v") == 1, F.lit("z ")).otherwise(F.lit("a ")), F.col("city")).alias(spec.columns[3]),
        F.lit("S").alias(spec.columns[4]))
    landing = csv_src.write_csv(rows, f"{root}/landing")
    jobs.load_raw(spark, spec, landing, f"{root}/lake")
    jobs.load_trusted(spark, spec, f"{root}/lake")
    return layers.read_layer(spark, jobs.table_path(f"{root}/lake", jobs.TRUSTED, spec))


def stream_over_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 three times, then a drop through the stream (J5): the drop is in all layers."""
    from strata.streaming.incremental import watch_tables

    spec = S.SELLERS
    root = work_dir(spark, "stream_over_lake")
    base = f"{root}/lake"
    feed = standins.feed(spark, sf_dir, spec)
    land_in_order(feed, list(spec.key), f"{root}/batch/{spec.source_file}")
    for _ in range(3):
        jobs.run_all(spark, f"{root}/batch", base, specs=(spec,), write_mode=tables.OVERWRITE)
    land_in_order(second_drop(feed, spec), list(spec.key), f"{root}/stream/{spec.source_file}")
    errors = watch_tables(spark, f"{root}/stream", base, (spec,), checkpoint_root=f"{root}/checkpoints")
    if errors:
        raise RuntimeError(f"stream failed: {errors}")
    return spark.read.parquet(jobs.table_path(base, jobs.REFINED, spec))


def refined_failed_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An overwrite whose strict dates fail leaves the rows published before."""
    spec = S.ORDERS
    root = work_dir(spark, "refined_failed_overwrite")
    base = f"{root}/lake"
    feed = standins.feed(spark, sf_dir, spec)
    bad = feed.withColumn("order_approved_at", F.concat(F.lit("free text "), F.col("order_id")))
    for n, drop in enumerate((feed, bad)):
        landing = csv_src.write_csv(drop, f"{root}/landing-{n}")
        jobs.load_raw(spark, spec, landing, base)
        jobs.load_trusted(spark, spec, base, raw_unique=True)
        try:
            jobs.load_refined(spark, spec, base, write_mode=tables.OVERWRITE)
            failed = False
        except Exception:  # noqa: BLE001 - any failure; that there is one is checked below
            failed = True
        if failed != (n == 1):
            raise RuntimeError("the strict load has to fail on free text, and only there")
    return spark.read.parquet(jobs.table_path(base, jobs.REFINED, spec))
