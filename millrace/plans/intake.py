"""Sources, sinks, payloads and validation."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.hashing import key_hash
from millrace.operators import cleaning, validation
from millrace.plans.fixtures import feat, sql_hash
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import files, payloads, uris
from millrace.sources.tables import table

FEATURE_NAMES = [f"f{i}" for i in range(64)]


@query(
    "csv_scan_clean",
    f"SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE {sql_hash('o_orderkey')} % 20 <> 0",
)
def csv_scan_clean(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(key_hash("o_orderkey") % 20 != 0, F.col("o_totalprice")).alias("o_totalprice")
    )
    path = files.write_csv(rows, scratch_path(spark, "csv"))
    return cleaning.drop_nulls(files.read_csv(spark, path, rows.schema))


@query("csv_drop_index", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def csv_drop_index(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    path = files.write_csv(rows.select(F.col("c_custkey").alias(files.INDEX_COLUMN), "*"), scratch_path(spark, "csv"))
    schema = T.StructType([T.StructField(files.INDEX_COLUMN, T.LongType()), *rows.schema.fields])
    return files.read_csv(spark, path, schema, index_column=True)


@query("parquet_sink", "SELECT id, f1, round(f2, 6) AS f2, cat, batch_id FROM feat", views=("feat",))
def parquet_sink(spark, sf):
    path = files.write_parquet(feat(spark, sf).drop("ts"), scratch_path(spark, "parquet"), ["cat"])
    return spark.read.parquet(path).select("id", "f1", F.round("f2", 6).alias("f2"), "cat", "batch_id")


@query("json_rows", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_rows(spark, sf):
    """Customers in debt as single objects, the others as arrays of at most eight."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    single = rows.where("c_acctbal < 0").select(F.to_json(F.struct("*")).alias("doc"))
    grouped = (
        rows.where("c_acctbal >= 0")
        .groupBy(F.floor(F.col("c_custkey") / 8))
        .agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("doc"))
        .select("doc")
    )
    return files.json_rows(single.unionByName(grouped), "doc", rows.schema)


@query(
    "corrupt_record_split",
    f"""
    SELECT CASE WHEN b THEN NULL ELSE c_custkey END AS c_custkey, CASE WHEN b THEN NULL ELSE c_acctbal END AS c_acctbal,
           CASE WHEN b THEN 'error' ELSE 'ok' END AS status, CASE WHEN b THEN '{{"c_custkey":' || c_custkey || ',"c_ac' END AS error_line
    FROM (SELECT *, {sql_hash('c_custkey')} % 25 = 0 AS b FROM customer)
    """,
)
def corrupt_record_split(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    broken = F.concat(F.lit('{"c_custkey":'), F.col("c_custkey").cast("string"), F.lit(',"c_ac'))
    lines = rows.select(F.when(key_hash("c_custkey") % 25 == 0, broken).otherwise(F.to_json(F.struct("*"))).alias("value"))
    path = scratch_path(spark, "jsonl")
    lines.write.text(path)
    out = files.tag_corrupt(files.read_json_lines(spark, path, rows.schema))
    return out.withColumns({c: F.when(F.col("status") == "ok", F.col(c)) for c in rows.columns})


def instances(spark, sf):
    """Embeddings as JSON instances, even ids as lists and odd ids as objects, damaged by id."""
    kind = F.col("vec_id") % 10
    as_list = F.col("vec_id") % 2 == 0

    def cell(x, i):
        text = x.cast("double").cast("string")
        return (
            F.when((kind == 2) & (i == 3), "null")
            .when((kind == 5) & (i == 7), "null")
            .when(kind.isin(3, 6) & (i == 9), '"n/a"')
            .when((kind == 7) & (i == 9), "true")
            .otherwise(text)
        )

    def entry(x, i):
        dropped = ((kind == 1) & (i == 5)) | ((kind == 4) & (i == 63))
        named = F.concat(F.lit('"f'), i.cast("string"), F.lit('":'), cell(x, i))
        return F.when(~dropped, F.when(as_list, cell(x, i)).otherwise(named))

    body = F.array_join(F.array_compact(F.transform("embedding", entry)), ",")
    text = F.when(as_list, F.concat(F.lit("["), body, F.lit("]"))).otherwise(F.concat(F.lit("{"), body, F.lit("}")))
    return table(spark, sf, "embeddings").select("vec_id", text.alias("instance"))


@query(
    "validate_instances",
    """
    SELECT vec_id, e = '' AS is_valid, e AS error FROM (
      SELECT vec_id, CASE vec_id % 10 WHEN 1 THEN 'Missing features: f5' WHEN 2 THEN 'All features must be numbers'
        WHEN 3 THEN 'Invalid type for feature f9: expected number' WHEN 4 THEN 'Expected 64 features, got 63'
        WHEN 5 THEN 'Null values in features: f7' WHEN 6 THEN 'All features must be numbers'
        WHEN 7 THEN 'Invalid type for feature f9: expected number' ELSE '' END AS e FROM embeddings)
    """,
)
def validate_instances(spark, sf):
    return validation.validate_instances(instances(spark, sf), "instance", FEATURE_NAMES).select("vec_id", "is_valid", "error")


@query(
    "shape_check",
    """
    SELECT vec_id, n AS n_features, n = 64 AS fits, CASE WHEN n <> 64 THEN 'Expected 64 features, got ' || n END AS error
    FROM (SELECT vec_id, CAST(len(embedding) - CASE WHEN vec_id % 10 IN (1, 4) THEN 1 ELSE 0 END AS INTEGER) AS n FROM embeddings)
    """,
)
def shape_check(spark, sf):
    short = F.filter("embedding", lambda x, i: ~(F.col("vec_id") % 10).isin(1, 4) | (i != 5))
    rows = table(spark, sf, "embeddings").select("vec_id", short.alias("features"))
    error = validation.shape_check(F.col("features"), 64)
    return rows.select("vec_id", F.size("features").alias("n_features"), error.isNull().alias("fits"), error.alias("error"))


def wide_payloads(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("features"))
    return payloads.encode_payloads(rows, "vec_id", "features", 5)


@query(
    "tensor_decode",
    """
    SELECT vec_id // 5 AS request, CAST(vec_id % 5 AS INTEGER) AS instance, CAST(i - 1 AS INTEGER) AS feature,
           round(CAST(embedding[i] AS DOUBLE), 6) AS value
    FROM embeddings, range(1, 65) t(i)
    """,
)
def tensor_decode(spark, sf):
    rows = payloads.decode_payloads(wide_payloads(spark, sf), "payload", ["request"])
    return rows.select("request", "instance", F.posexplode("features").alias("feature", "value")).withColumn("value", F.round("value", 6))


@query(
    "tensor_encode",
    """
    SELECT vec_id // 5 AS request, 'input-0' AS name, 'FP32' AS datatype, CAST(count(*) AS INTEGER) AS height, CAST(max(len(embedding)) AS INTEGER) AS width,
           CAST(sum(len(embedding)) AS INTEGER) AS cells, round(sum(list_sum(CAST(embedding AS DOUBLE[]))), 4) AS total FROM embeddings GROUP BY vec_id // 5
    """,
)
def tensor_encode(spark, sf):
    """The header of every payload and the sum of its cells, from the payload's JSON."""
    schema = "inputs array<struct<name string, shape array<int>, datatype string, data array<double>>>"
    one = wide_payloads(spark, sf).select("request", F.from_json("payload", schema)["inputs"][0].alias("t"))
    total = F.aggregate("t.data", F.lit(0.0), lambda a, x: a + x)
    return one.select(
        "request", "t.name", "t.datatype", F.col("t.shape")[0].alias("height"), F.col("t.shape")[1].alias("width"), F.size("t.data").alias("cells"), F.round(total, 4).alias("total")
    )


@query(
    "uri_split",
    """
    , q AS (SELECT page_id, CASE WHEN path LIKE '/minio/%' THEN substr(path, 8) ELSE ltrim(path, '/') END AS rest FROM p)
    SELECT page_id, 's3://' || rest AS uri, split_part(rest, '/', 1) AS bucket,
           CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/') + 1) ELSE '' END AS object_key FROM q
    """.replace(
        ", q AS",
        """WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/minio/' || regexp_replace(url, '^https?://', '')
                           WHEN page_id % 3 = 0 THEN regexp_replace(url, '^https?://([^/]*).*', '//\\1')
                           ELSE regexp_replace(url, '^https?:', '') END AS path FROM pages), q AS""",
        1,
    ),
)
def uri_split(spark, sf):
    path = (
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/minio/"), F.regexp_replace("url", "^https?://", "")))
        .when(F.col("page_id") % 3 == 0, F.regexp_replace("url", "^https?://([^/]*).*", "//$1"))
        .otherwise(F.regexp_replace("url", "^https?:", ""))
    )
    rows = table(spark, sf, "pages").select("page_id", path.alias("path"))
    p = F.col("path")
    return rows.select(
        "page_id", uris.storage_uri(p).alias("uri"), uris.bucket_of(p).alias("bucket"), uris.key_of(p).alias("object_key")
    )


@query(
    "rule_violations",
    """
    SELECT key, violation_text, CAST(n AS INTEGER) AS violation_count, CASE WHEN n > 0 THEN 'WARNING' ELSE 'PASSED' END AS validation_status
    FROM (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS key,
        concat_ws('; ', CASE WHEN NOT l_discount BETWEEN 0.01 AND 0.09 THEN printf('discount must be 0.01-0.09, got %.2f', l_discount) END,
          CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'flag must be A/N, got ''' || l_returnflag || '''' END,
          CASE WHEN NOT l_quantity >= 2 THEN printf('quantity must be at least 2, got %.2f', l_quantity) END) AS violation_text,
        (NOT l_discount BETWEEN 0.01 AND 0.09)::INT + (l_returnflag NOT IN ('A', 'N'))::INT + (NOT l_quantity >= 2)::INT AS n
      FROM lineitem)
    """,
)
def rule_violations(spark, sf):
    rules = [
        validation.in_range("discount", "l_discount", 0.01, 0.09),
        validation.one_of("flag", "l_returnflag", ["A", "N"]),
        validation.at_least("quantity", "l_quantity", 2),
    ]
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("key")
    rows = table(spark, sf, "lineitem").select(key, "l_discount", "l_returnflag", "l_quantity")
    return validation.apply_rules(rows, rules).select("key", "violation_text", "violation_count", "validation_status")


@query(
    "migrate_values",
    """
    SELECT p_partkey, p_type AS old_type, CASE p_type WHEN 'ECONOMY' THEN 'BUDGET' WHEN 'PROMO' THEN 'CAMPAIGN' ELSE p_type END AS new_type FROM part
    """,
)
def migrate_values(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("old_type"))
    return validation.migrate_values(rows, "old_type", {"ECONOMY": "BUDGET", "PROMO": "CAMPAIGN"}, "new_type")


@query(
    "unpivot_rows",
    """
    SELECT p_partkey, parameter, value, 'PASSED' AS validation_status, 'production' AS environment FROM (
      SELECT p_partkey, 'p_brand' AS parameter, p_brand AS value FROM part UNION ALL
      SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part UNION ALL
      SELECT p_partkey, 'p_retailprice', CAST(p_retailprice AS VARCHAR) FROM part)
    """,
)
def unpivot_rows(spark, sf):
    return validation.record_rows(
        table(spark, sf, "part"), ["p_partkey"], ["p_brand", "p_size", "p_retailprice"], "PASSED", "production"
    )
