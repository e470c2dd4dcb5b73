"""The registered queries of the operators: thin digests of their outputs over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_sql_defaults, cut_lineage, ensure_checkpoint_dir
from . import byte_bpe, decontaminate, html_templates, line_crf, merkle, minhash, pii, quality, simhash, super_kmers, token_counts, warc, word_runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(body: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return body(apply_sql_defaults(spark), sf_dir)

    QUERIES[body.__name__] = run
    return body


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@_query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@_query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", _sha256(F.array_join("items", ",")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"), "longest_match")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES["op10_decontaminate"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
bl AS (SELECT *, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM bl)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bl))),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS digest
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id),
runs AS (SELECT doc_id, max(p + k - s) AS longest FROM (
  SELECT doc_id, item_id, min(i) AS s, max(i) AS p, any_value(n) AS k FROM (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id, item_id, j - i ORDER BY i) AS g, j - i AS dg FROM (
      SELECT h.doc_id, h.item_id, h.i, h.n, j FROM hit h JOIN (
        SELECT item_id, n, array_to_string(w[j:j + n - 1], ' ') AS win, j FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS j FROM bl)) t
        ON t.item_id = h.item_id AND t.n = h.n
        JOIN dw ON dw.doc_id = h.doc_id AND dw.i = h.i AND dw.n = h.n AND dw.win = t.win))
    GROUP BY doc_id, item_id, dg, g) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(longest, 0) AS longest_match
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN runs USING (doc_id)"""


@_query
def op6_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return super_kmers.remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


_WORDS = r"[^\x20\x09-\x0D]+"

ORACLES["op6_super_kmers"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
k AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS first FROM k),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM f WHERE doc_id > first) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: ps IS NULL OR NOT list_contains(ps, i)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)"""


@_query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@_query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op1_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_templates.extract(_table(spark, sf_dir, "pages"))


@_query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4().hex}"
    warc.write_archive(_table(spark, sf_dir, "pages"), path)
    records = cut_lineage(warc.read_records(spark, path))
    archive = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    archive.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(archive, True)
    found = warc.assemble(records)
    return found.select("page_id", "response.payload_bytes", "response.payload_digest", F.col("response.kind").alias("record_type"), "response.refers_to")


ORACLES["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT *, strlen(body) AS payload_bytes, sha1(body) AS hex FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS top,
  [CAST('0x' || substr(hex, 1 + 10 * k, 10) AS BIGINT) FOR k IN range(4)] AS groups FROM d)
SELECT page_id, payload_bytes,
  array_to_string(flatten([[substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((v >> (35 - 5 * j)) & 31) AS BIGINT), 1) FOR j IN range(8)] FOR v IN groups]), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM g"""


@_query
def op4_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_crf.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scores = quality.score(docs, *quality.train(docs, _table(spark, sf_dir, "labels")))
    return scores.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@_query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


# Unsigned CRC-32 of a decimal number: the table by eight steps per byte, then one look-up per digit.
_CRC_TABLE = """crc AS (SELECT list(list_reduce(list_prepend(k, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS tab
  FROM (SELECT unnest(range(256)) AS k))"""


def _crc(of: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({of} AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)), "
            "lambda c, x: xor(c >> 8, tab[1 + (xor(c, x) & 255)])), 4294967295)")


def _repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which one document of ten repeats its words from some place on (the rule of the query's contract)."""
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    chosen = docs.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))))
    a = F.floor(F.col("h") / 10) % F.size("w")
    placed = chosen.withColumn("a", F.when(F.size("w") > 0, a).cast("int"))
    rest = F.size("w") - F.col("a")
    sized = placed.withColumn("p", (1 + F.floor(rest / (3 + F.floor(F.col("h") / 10) % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    words = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), rest))
    return sized.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(words, " ")).alias("text"))


@_query
def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs.find_runs(_repeated_tails(_table(spark, sf_dir, "documents")))

    def order(a, b):  # the greatest exponent first, compared without division, then the smallest start and period
        mine, other = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(mine != other, F.when(mine > other, -1).otherwise(1)).when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
                .otherwise(F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)))

    best = found.withColumn("best", F.get(F.array_sort("runs", order), F.lit(0)))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       _sha256(F.array_join(lines, "")).alias("runs_sha256"), _sha256(F.col("kept")).alias("collapsed_sha256"))


ORACLES["op11_word_runs"] = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w, {_crc('doc_id')} AS h FROM documents, crc),
e AS (SELECT *, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS parts FROM d),
x AS (SELECT doc_id, CASE WHEN a IS NULL THEN w ELSE list_transform(range(len(w)), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // parts) END]) END AS w FROM e),
t AS (SELECT doc_id, len(w) AS n, unnest(range(len(w))) AS i, unnest(w) AS word FROM x),
s AS (SELECT a.doc_id, b.i - a.i AS q, a.i FROM t a JOIN t b ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i AND b.i - a.i <= a.n // 4),
g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM s),
m AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS n FROM g GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.doc_id = m.doc_id AND o.q < m.q AND o.s <= m.s AND o.s + o.n >= m.s + m.n)),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n::DOUBLE / q DESC, s, q) AS k FROM r),
f AS (SELECT doc_id, count(*) AS n_runs, max(s) FILTER (k = 1) AS start, max(n) FILTER (k = 1) AS length, max(q) FILTER (k = 1) AS period,
  sha256(string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q)) AS runs_sha256 FROM b GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM r),
kept AS (SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS collapsed FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  coalesce(runs_sha256, sha256('')) AS runs_sha256, coalesce(collapsed, sha256('')) AS collapsed_sha256
FROM x LEFT JOIN f USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@_query
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


ORACLES["op12_minhash"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS same FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * same >= 80 * (a.n + b.n - same)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
c AS (SELECT x AS doc_id, min(y) AS least FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id, doc_id <= coalesce(least, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"""


@_query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    later = merkle.leaf([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    found = merkle.verify(merkle.prove(merkle.manifest(docs, claimed=F.when(tampered, later))))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _level(up: int, by: str, source: str) -> str:
    """One level of all trees: pairs of neighbours, roots unchanged."""
    return (f"SELECT {by}, i // 2 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, "
            f"(any_value(n) + 1) // 2 AS n FROM {source} GROUP BY {by}, i // 2")


def _merkle_sql(levels: int = 20, top: int = 6) -> str:
    """Trees level by level, up to 2 ** levels rows a language and 2 ** top languages, then each row's way up."""
    def coded(c: str, value: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"

    def hashed(n_chars: str) -> str:
        fields = [(c, f"CAST({n_chars if c == 'n_chars' else c} AS VARCHAR)") for c in merkle.FIELDS]
        return f"sha256({' || '.join(coded(*f) for f in fields)})"

    parts = [_CRC_TABLE, f"""d AS (SELECT doc_id, lang, {hashed('n_chars')} AS h, CASE WHEN {_crc('doc_id')} % 7 = 0 THEN {hashed('n_chars + 1')} ELSE {hashed('n_chars')} END AS f FROM documents, crc)""",
             "t0 AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d)"]
    parts += [f"t{k + 1} AS ({_level(k, 'lang', f't{k}')})" for k in range(levels)]
    parts.append(f"s0 AS (SELECT lang, 0 AS one, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t{levels})")
    parts += [f"s{k + 1} AS ({_level(k, 'one', f's{k}')})" for k in range(top)]
    parts.append("w0 AS (SELECT doc_id, lang, i, h AS leaf, f, '' AS sib FROM t0)")
    step = ("SELECT w.* REPLACE (w.i // 2 AS i, w.sib || coalesce(b.h, '') AS sib, CASE WHEN {n} = 1 THEN w.f WHEN b.h IS NULL THEN sha256(w.f) "
            "WHEN w.i % 2 = 0 THEN sha256(w.f || b.h) ELSE sha256(b.h || w.f) END AS f) FROM {w} w JOIN {t} a ON {key} AND a.i = w.i LEFT JOIN {t} b ON {keyb} AND b.i = xor(w.i, 1)")
    parts += [f"w{k + 1} AS ({step.format(n='a.n', w=f'w{k}', t=f't{k}', key='a.lang IS NOT DISTINCT FROM w.lang', keyb='b.lang IS NOT DISTINCT FROM w.lang')})" for k in range(levels)]
    parts.append(f"v0 AS (SELECT w.* REPLACE (s0.i AS i), s0.h AS subroot FROM w{levels} w JOIN s0 ON s0.lang IS NOT DISTINCT FROM w.lang)")
    parts += [f"v{k + 1} AS ({step.format(n='a.n', w=f'v{k}', t=f's{k}', key='true', keyb='true')})" for k in range(top)]
    return f"""WITH {', '.join(parts)}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(sib) AS proof_sha256, f AS folded_root, f = r.h AS verified FROM v{top} JOIN s{top} r ON true"""


ORACLES["op13_merkle"] = _merkle_sql()
