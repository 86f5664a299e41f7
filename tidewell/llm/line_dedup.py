"""Cross-site boilerplate lines, with DataFrame functions only.

Each line is known by two hashes. A HyperLogLog sketch of the sites is built per line on the map side and merged by
the shuffle aggregation. Lines whose estimate is clear of the threshold are decided by it; those near it get an exact
distinct count. Only hashes and positions are shuffled until the last join, which brings each text its removed lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import words
from tidewell.session import materialize

MIN_SITES = 10
LOG_K = 12
MARGIN = 0.15


def _key(c: Column) -> list[Column]:
    return [F.xxhash64(c).alias("h1"), F.hash(c, F.length(c)).alias("h2")]


def boilerplate_lines(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES, log_k: int = LOG_K, margin: float = MARGIN) -> DataFrame:
    """Keys (h1, h2) of the lines found on at least min_sites distinct sites.

    margin: estimates within this share of min_sites (1 site at least) are counted exactly; it is nine standard errors
    of a sketch of 2**12 bins. A null site is no site; blank lines never count.
    """
    lines = docs.select(F.col(site).cast("string").alias("site"), F.explode(F.split(F.col(text), "\n", -1)).alias("line")).where(F.col("site").isNotNull() & (F.trim("line") != ""))
    keyed = lines.select(*_key(F.col("line")), "site")
    seen = keyed.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", log_k).alias("sketch"), F.min("site").alias("lo"), F.max("site").alias("hi"))
    if min_sites > 1:
        seen = seen.where(F.col("lo") != F.col("hi"))
    est = seen.select("h1", "h2", F.hll_sketch_estimate("sketch").alias("est"))
    slack = max(1.0, margin * min_sites)
    # a table of its own, so that the joins below read plain exchanges, which Spark can split where a line is hot
    est = materialize(est.where(F.col("est") > min_sites - slack), "line-sites")
    sure = est.where(F.col("est") >= min_sites + slack).select("h1", "h2")
    near = est.where(F.col("est") < min_sites + slack).select("h1", "h2")
    exact = keyed.join(near, ["h1", "h2"], "left_semi").distinct().groupBy("h1", "h2").count().where(F.col("count") >= min_sites).select("h1", "h2")
    return sure.unionByName(exact)


def _positions(lines: DataFrame, boiler: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Boilerplate lines of each distinct text: (t1, t2, pos) and more columns, once each."""
    hit = lines.select("t1", "t2", "pos", *more, *_key(F.col("line"))).join(boiler, ["h1", "h2"], "left_semi")
    return hit.groupBy("t1", "t2", "pos").agg(*[F.max(c).alias(c) for c in (*more, "h1", "h2")])


def _proven(lines: DataFrame, boiler: DataFrame, min_sites: int, copy_share: float) -> DataFrame:
    """(t1, t2, gone): positions to remove from each text, for texts that may be copies of whole documents.

    Texts of which boilerplate takes at most copy_share prove its lines; the others lose only lines proven on min_sites
    of those.
    """
    once = _positions(lines.select("*", F.length("line").alias("n")), boiler, ("n", "size"))
    found = once.groupBy("t1", "t2").agg(F.collect_list(F.struct("pos", "h1", "h2")).alias("at"), F.sum("n").alias("n"), F.max("size").alias("size"))
    found = materialize(found, "boilerplate-positions")
    light = F.col("n") <= copy_share * F.col("size")
    spread = found.where(light).select(F.explode(F.array_distinct(F.transform("at", lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"))))).alias("k"))
    known = spread.groupBy("k.h1", "k.h2").count().where(F.col("count") >= min_sites).select("h1", "h2")
    heavy = found.where(~light).select("t1", "t2", F.explode("at").alias("x")).select("t1", "t2", "x.*").join(known, ["h1", "h2"], "left_semi")
    some = found.where(light).select("t1", "t2", F.transform("at", lambda x: x["pos"]).alias("gone"))
    return some.unionByName(heavy.groupBy("t1", "t2").agg(F.collect_list("pos").alias("gone")))


def remove_boilerplate(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES, copy_share: float | None = None) -> DataFrame:
    """docs with ``text`` less its boilerplate lines, and ``n_lines``, ``n_removed_lines``.

    All rows and other columns stay (columns named n_lines or n_removed_lines are replaced; other names can't clash). A
    text of boilerplate alone becomes empty. copy_share (off by default): a text of which boilerplate takes more than this
    share of the characters may be a copy of a whole document; it loses only those of its boilerplate lines that are also
    on min_sites distinct texts below that share, and is left to document-level deduplication otherwise. A null text stays
    null with 0 lines; an empty text has one empty line. Repeated rows are treated alike, for a text's lines depend on the
    text alone; every row adds its site. An empty table gives no rows.
    """
    base = docs.drop("n_lines", "n_removed_lines")
    body = F.col(text)
    packed = base.select(F.struct(*[F.col(c) for c in base.columns]).alias("row"), body.alias("t"), F.xxhash64(body).alias("t1"), F.hash(body, F.length(body)).alias("t2"))
    texts = packed.select("t1", "t2", "t").where(F.col("t").isNotNull())
    lines = texts.select("t1", "t2", F.length("t").alias("size"), F.posexplode(F.split("t", "\n", -1)).alias("pos", "line")).where(F.trim("line") != "")
    boiler = materialize(boilerplate_lines(docs, text, site, min_sites), "boilerplate")
    if copy_share is None:
        gone = _positions(lines, boiler).groupBy("t1", "t2").agg(F.collect_list("pos").alias("gone"))
    else:
        gone = _proven(lines, boiler, min_sites, copy_share)
    both = words.spread_join(packed.drop("t"), gone, ["t1", "t2"]).select("row", "gone", F.split(F.col("row")[text], "\n", -1).alias("parts"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone"), lambda i: F.get("parts", i))
    whole = F.col("row")[text]
    columns = [(F.when(F.col("gone").isNull(), whole).otherwise(F.array_join(kept, "\n")) if c == text else F.col("row")[c]).alias(c) for c in base.columns]
    counts = [F.when(whole.isNull(), F.lit(0)).otherwise(F.size("parts")), F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone"))]
    return both.select(*columns, *[c.cast("long").alias(n) for c, n in zip(counts, ("n_lines", "n_removed_lines"), strict=True)])


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its line counts and the digest of what is kept of its text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    out = remove_boilerplate(docs)
    return out.select("doc_id", "n_lines", "n_removed_lines", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, source FROM documents),
lines AS (
  SELECT r, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM d WHERE text IS NOT NULL
), boiler AS (
  SELECT line FROM lines WHERE trim(line) <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}
), marked AS (
  SELECT l.r, l.pos, l.line, b.line IS NOT NULL AS hit FROM lines l LEFT JOIN boiler b ON l.line = b.line
), per AS (
  SELECT r, count(*) AS n, count(*) FILTER (hit) AS k, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit) AS kept FROM marked GROUP BY r
), done AS (
  SELECT d.doc_id, coalesce(per.n, 0) AS n_lines, coalesce(per.k, 0) AS n_removed_lines, coalesce(per.kept, '') AS kept
  FROM d LEFT JOIN per ON d.r = per.r
)
SELECT doc_id, n_lines, n_removed_lines, length(kept) AS kept_chars, sha256(kept) AS kept_sha256 FROM done
"""
