"""Registered queries of the corpus operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_utc
from . import (ann, chat, collocations, decontaminate, html_text, language_id, line_dedup, ngram_join, runs,
               secrets, sentence_pieces, substring_dedup, warc)
from .ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(key: str, sql: str | None = None):
    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            ship(spark)
            return fn(spark, sf_dir)
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
           r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
           r"[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)")


def _span_sql(kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
      SELECT rid, {kind} AS k, unnest(list_filter(list_transform(range(1, len(m) + 1), lambda i: struct_pack(
          a := list_sum(list_transform(b[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
          n := length(m[i]), g := length(g[i]))), lambda s: s.g >= {least})) AS s
      FROM (SELECT rid, string_split_regex(t, '{pattern}') AS b, regexp_extract_all(t, '{pattern}', 0) AS m,
                   regexp_extract_all(t, '{pattern}', {group}) AS g
            FROM d WHERE regexp_matches(t, '{pattern}'))"""


@_register("op1_secrets", f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    s AS ({_span_sql("0", _ASSIGN, 2, 12)} UNION ALL {_span_sql("1", "AKIA[A-Z0-9]{14,}", 0, 18)}
          UNION ALL {_span_sql("2", "[0-9a-f]{16,}", 0, 16)}),
    j AS (SELECT rid, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2,
            string_agg((['assign', 'access', 'hex'])[k + 1] || ':' || CAST(s.a AS BIGINT) || ':'
                       || CAST(s.a + s.n AS BIGINT), ',' ORDER BY s.a, k) AS spans
          FROM s GROUP BY rid)
    SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
           sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN j USING (rid)""")
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three base rules; verification by regex finds just the base spans, the index adds none."""
    rules = secrets.RULES
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"), rules)
    spans = F.array_join(F.transform("__found", lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(i: int):
        return F.size(F.filter("__found", lambda s: s["kind"] == i)).cast("long").alias(f"n_{rules[i].kind}")

    return (found.select(F.col("doc_id").cast("long").alias("doc_id"), *map(count, range(len(rules))), spans.alias("spans"))
            .withColumn("base_sha256", F.sha2("spans", 256)))


_LINE_KEY = ("translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), "
             f"'{line_dedup.UPPER}', '{line_dedup.LOWER}')")


@_register("op10_line_dedup", f"""
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    e AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
    k AS (SELECT *, {_LINE_KEY} AS key FROM e),
    f AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= {line_dedup.MIN_CHARS}
          GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
    m AS (SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.keep AS lost
          FROM k LEFT JOIN f ON k.key = f.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
    FROM m GROUP BY doc_id""")
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return line_dedup.with_kept_text(docs).select(
        "row.doc_id", "n_lines", F.col("n_lost").alias("n_dropped"), F.sha2("kept", 256).alias("kept_sha256"))


@_register("op7_warc", """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE octet_length(b) >= 100 GROUP BY 1)
    SELECT page_id, octet_length(b) AS payload_bytes, p.payload_digest,
           CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND octet_length(b) >= 100""")
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(spark, _table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_register("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       language_id.held_out(F.col("doc_id")).alias("held_out"), "text")
    return language_id.with_language(rows, model).select(
        "doc_id", "held_out", F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


@_register("op9_main_text")
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.with_main_text(pages).select(
        "page_id", "url", F.col("__main").alias("text"), F.char_length("__main").cast("long").alias("n_chars"))


@_register("op6_ann")
def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


@_register("op2_sentence_pieces")
def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode it again; scores of the N best, digests of ids and of the decoded text."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = sentence_pieces.encoded(docs, sentence_pieces.Vocabulary.load())
    return rows.select(
        "doc_id", F.size("__ids").cast("long").alias("n_tokens"), F.col("__piece_score").alias("score"),
        F.transform("__paths", lambda p: p["score"]).alias("next_scores"),
        F.sha2(F.array_join(F.col("__ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("__decoded", 256).alias("decoded_sha256"),
        (F.col("__decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


@_register("op4_decontaminate")
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and test item that it leaks."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = decontaminate.with_leaks(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("__leaks")).select("doc_id", "item_id", "score", "question", "answer")


@_register("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_register("op3_ngram_join")
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = ngram_join.linked(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "n_links")


def _with_repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of documents whose crc32(doc_id) ends in 0, the words from place a on repeat the p words there."""
    split = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
            .withColumn("g", F.expr("h div 10"))
            .withColumn("words", F.when(F.col("h") % 10 == 0, split))
            .withColumn("n", F.when(F.size("words") > 0, F.size("words")))
            .withColumn("a", (F.col("g") % F.col("n")).cast("int"))
            .withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)")))
    word = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(word, " ")).otherwise(F.col("text")).alias("text"))


@_register("op11_runs", r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                 list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
                 xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
                   string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                   lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                     lambda y, z: xor(y >> 1, (y & 1) * 3988292384)))) AS h FROM documents),
    g AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
    q AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g),
    t AS (SELECT rid, n, i, CASE WHEN a IS NULL OR i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END AS word
          FROM (SELECT *, unnest(range(n)) AS i FROM q)),
    pairs AS (SELECT x.rid, y.i - x.i AS p, x.i FROM t x JOIN t y
              ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    stretch AS (SELECT rid, p, min(i) AS s, count(*) + p AS len FROM (
                  SELECT *, i - row_number() OVER (PARTITION BY rid, p ORDER BY i) AS k FROM pairs)
                GROUP BY rid, p, k HAVING count(*) + p >= greatest(6, 4 * p)),
    r AS (SELECT rid, s, len, min(p) AS p FROM stretch GROUP BY rid, s, len),
    b AS (SELECT rid, count(*) AS n_runs, sha256(string_agg(concat(s, ',', len, ',', p, chr(10)), '' ORDER BY s, p)) AS runs_sha256,
            arg_max({'s': s, 'len': len, 'p': p}, [len, -s, -p]) AS best FROM r GROUP BY rid),
    gone AS (SELECT DISTINCT rid, i FROM t JOIN r USING (rid) WHERE i >= s + p AND i < s + len),
    c AS (SELECT rid, sha256(string_agg(word, ' ' ORDER BY i)) AS h FROM t ANTI JOIN gone USING (rid, i) GROUP BY rid)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, CAST(best.len AS BIGINT) AS length, best.p AS period,
           CAST(1000 * best.len // best.p AS BIGINT) AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
           coalesce(c.h, sha256('')) AS collapsed_sha256
    FROM d LEFT JOIN b USING (rid) LEFT JOIN c USING (rid)""")
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.with_runs(_with_repeated_tails(_table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@_register("op12_collocations", rf"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                 translate(coalesce(text, ''), '{line_dedup.UPPER}', '{line_dedup.LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    q AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
    g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
          FROM (SELECT *, unnest([1, 2, 3]) AS k FROM q) WHERE len(w) >= k),
    f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase),
    c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND a >= {collocations.LEAST_COUNT}),
    e AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
    s AS (SELECT e.lang, e.k, e.phrase, e.a, e.cut, x.a AS l, y.a AS r,
            CAST({collocations.SCALE}::HUGEINT * e.a * e.a // (x.a::HUGEINT * y.a) AS BIGINT) AS score
          FROM e JOIN f x ON x.lang = e.lang AND x.phrase = array_to_string(e.w[:e.cut], ' ')
                 JOIN f y ON y.lang = e.lang AND y.phrase = array_to_string(e.w[e.cut + 1:], ' ')),
    b AS (SELECT lang, k, phrase, a, unnest(arg_min({{'l': l, 'r': r, 'score': score}}, [score, cut])) FROM s GROUP BY lang, k, phrase, a),
    i AS (SELECT lang, part, max(a) AS longer FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part
                                                    FROM c WHERE k = 3) GROUP BY lang, part),
    o AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.part = b.phrase
          WHERE longer IS NULL OR 100::HUGEINT * longer < {collocations.COVERED}::HUGEINT * a),
    t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM q GROUP BY lang)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM o JOIN t USING (lang) QUALIFY rank <= {collocations.TOP}""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents").select("text", "lang"))


@_register("op13_chat", """
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    e AS (SELECT *, regexp_replace(text, '<(\\\\*)(\\|im_start\\|>|\\|im_sep\\|>|\\|im_end\\|>|\\|endoftext\\|>|s>|/s>|<SYS>>|</SYS>>)|\\[(\\\\*)(INST\\]|/INST\\])',
                 'xx\\0', 'g') AS longer FROM c)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(role) + length(text) + (length(longer) - length(text)) // 2 + 32) AS BIGINT) AS formatted_chars
    FROM e GROUP BY conv_id""")
def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame([(-1, t, r, "</s>[INST] ok [/INST]") for t, r in enumerate(("user", "assistant"))],
                                "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return chat.read_back(*chat.formatted(rows.unionByName(own)))
