"""The registered queries of the operators, with production parameters, and SQL to check them."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    common,
    jaccard,
    lexical,
    licenses,
    mixing,
    packing,
    quality,
    runs,
    secrets,
    sharding,
    token_files,
    top_k,
    toxicity,
    warc,
)

# Small enough that the smallest tables are split too.
SHARD_BYTES = 160 << 10

# A row's bucket is its shortest prefix of the hash that fits, as only buckets that do not are split.
OP1_SQL = f"""
WITH hashed AS (
    SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
        lpad(bin(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT), 60, '0') AS bits
    FROM documents
),
prefixes AS (SELECT *, unnest(range(0, 61))::INT AS depth FROM hashed),
buckets AS (
    SELECT doc_id, n_bytes, depth, substr(bits, 1, depth) AS shard,
        sum(n_bytes) OVER (PARTITION BY depth, substr(bits, 1, depth))::BIGINT AS shard_bytes,
        count(*) OVER (PARTITION BY depth, substr(bits, 1, depth)) AS n_rows
    FROM prefixes
)
SELECT doc_id, n_bytes, shard, depth, shard_bytes FROM buckets
WHERE shard_bytes <= {SHARD_BYTES} OR n_rows = 1
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""

# Base 32 takes 5 bits a letter: 5 hex digits give 4 letters.
OP8_SQL = """
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
),
named AS (
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(hex, (1 + 5 * (i // 4))::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '')
        AS payload_digest
    FROM hashed
),
firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM named
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""

BIN_CHARS = 16_384
# Sources weigh as much as the square root of their size.
MIX_TEMPERATURE, MIX_SEED = 0.5, "mix"

OP7_SQL = f"""
WITH sizes AS (
    SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS size FROM documents GROUP BY source
),
rates AS (
    SELECT source, pow(size, {MIX_TEMPERATURE}) / sum(pow(size, {MIX_TEMPERATURE})) OVER ()
        * sum(size) OVER () / size AS rate
    FROM sizes WHERE size > 0
),
pieces AS (
    SELECT source, unnest(range(1, ceil(rate / {mixing.PIECE})::BIGINT + 1)) AS piece,
        rate / ceil(rate / {mixing.PIECE}) AS mean
    FROM rates
),
ladder AS (
    SELECT source, piece, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1)))
        OVER (PARTITION BY source, piece ORDER BY k) AS reached
    FROM (SELECT *, unnest(range(0, ceil(mean + 12 * sqrt(mean) + 20)::BIGINT + 1)) AS k FROM pieces)
),
counted AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, count(*) AS copies
    FROM documents d JOIN ladder USING (source)
    WHERE reached <= ('0x' || substr(md5('{MIX_SEED}:' || piece || ':' || d.doc_id), 1, 13))::BIGINT / pow(16, 13)
    GROUP BY ALL
),
copied AS (SELECT * EXCLUDE copies, unnest(range(1, copies + 1))::INT AS copy FROM counted)
SELECT *, ('0x' || substr(md5('{MIX_SEED}:order:' || doc_id || ':' || copy), 1, 13))::BIGINT / pow(16, 13)
    AS shuffle_key
FROM copied
"""

TOP_K = 5
OP9_SQL = f"""
WITH vectors AS (
    SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.row_id, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY row_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY score DESC, vec_id) <= {TOP_K}
"""

_SPACE = r"[\x20\x09-\x0D]"
OP10_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text FROM documents
),
words AS (
    SELECT row_id, unnest(found) AS word, unnest(range(len(found))) AS pos
    FROM (SELECT row_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS found FROM docs)
),
windows AS (
    SELECT row_id, pos, word AS a, lead(word) OVER (w) AS b, lead(word, 2) OVER (w) AS c
    FROM words WINDOW w AS (PARTITION BY row_id ORDER BY pos)
),
repeated AS (
    SELECT row_id, pos FROM windows WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY row_id, a, b, c) > 1
),
repeats AS (
    SELECT row_id, count(DISTINCT place) AS n_repeat_words
    FROM (SELECT row_id, unnest([pos, pos + 1, pos + 2]) AS place FROM repeated) GROUP BY row_id
),
base AS (
    SELECT row_id, doc_id, source, text,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS n_words,
        length(regexp_replace(text, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols
    FROM docs
),
raw_lines AS (
    SELECT row_id, source, unnest(string_split(text, chr(10))) AS line FROM docs
),
own_lines AS (SELECT * FROM raw_lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (
    SELECT row_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM own_lines GROUP BY row_id
),
lines AS (
    SELECT row_id, source,
        trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'),
            '{_SPACE}+', ' ', 'g'), ' ') AS line
    FROM own_lines
),
frequent AS (
    SELECT source, line FROM lines GROUP BY source, line
    HAVING count(DISTINCT row_id) > CASE WHEN regexp_matches(line, '^(?:[0 [:punct:]]*[^0 [:punct:]]){{{quality.LONG_LINE}}}')
        THEN {quality.MIN_DOCS} ELSE {quality.SHORT_DOCS} END
),
removed AS (
    SELECT row_id, sum(len(regexp_extract_all(lines.line, '[^\x20\x09-\x0D]+')))::BIGINT AS removed_words
    FROM lines JOIN frequent f ON lines.source IS NOT DISTINCT FROM f.source AND lines.line = f.line GROUP BY row_id
),
counted AS (
    SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(removed_words, 0)::BIGINT AS removed_words
    FROM base LEFT JOIN repeats USING (row_id) LEFT JOIN dup USING (row_id) LEFT JOIN removed USING (row_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND n_words - removed_words >= {quality.MIN_WORDS}
        AND n_words - removed_words >= {quality.MIN_LEFT} * n_words AS kept
FROM counted
"""

# The checksum goes through a number's bits, eight for each of its digits.
OP11_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
            lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
            lambda crc, x: xor(xor(crc, x) >> 1, (xor(crc, x) & 1) * 3988292384)), 4294967295) AS h
    FROM documents
),
marked AS (SELECT *, len(words) AS n, h // 10 AS g, coalesce(h % 10 = 0, false) AND len(words) > 0 AS planted FROM docs),
cut AS (SELECT *, CASE WHEN planted THEN g % n END AS a FROM marked),
periodic AS (SELECT *, CASE WHEN planted THEN 1 + (n - a) // (3 + g % 8) END AS p FROM cut),
own AS (
    SELECT row_id, doc_id, n, CASE WHEN planted
        THEN list_transform(range(n), lambda i: words[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END])
        ELSE words END AS words
    FROM periodic
),
words AS (SELECT row_id, n, unnest(words) AS word, unnest(range(n)) AS i FROM own),
same AS (
    SELECT x.row_id, y.i - x.i AS period, x.i AS i FROM words x JOIN words y
    ON x.row_id = y.row_id AND x.word = y.word AND y.i > x.i AND 2 * (y.i - x.i) <= x.n
),
islands AS (
    SELECT row_id, period, i, i - row_number() OVER (PARTITION BY row_id, period ORDER BY i) AS island FROM same
),
stretches AS (
    SELECT row_id, period, min(i) AS start, count(*) + period AS length FROM islands GROUP BY row_id, period, island
),
runs AS (
    SELECT row_id, start, length, min(period) AS period FROM stretches
    WHERE length >= {runs.MIN_WORDS} AND length >= 2 * period GROUP BY row_id, start, length
),
lists AS (
    SELECT row_id, count(*) AS n_runs,
        first(struct_pack(start := start, length := length, period := period) ORDER BY length DESC, start, period) AS best,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
    FROM runs GROUP BY row_id
),
dropped AS (SELECT DISTINCT row_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT row_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN dropped USING (row_id, i) GROUP BY row_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length,
    best.period::BIGINT AS period, (1000 * best.length // best.period)::BIGINT AS exponent_milli,
    sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM own LEFT JOIN lists USING (row_id) LEFT JOIN kept USING (row_id)
"""

OP12_TOP = 10
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP12_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS terms FROM documents
),
totals AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0),
counts AS (
    SELECT row_id, doc_id, n, term, count(*) AS tf FROM (SELECT row_id, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
    GROUP BY ALL
),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, totals GROUP BY term
),
items AS (
    SELECT DISTINCT item_row, item_id, term FROM (
        SELECT row_number() OVER () AS item_row, item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark
    )
),
scores AS (
    SELECT item_row, item_id, row_id, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM items JOIN counts USING (term) JOIN weights USING (term), totals GROUP BY ALL
)
SELECT item_id, (row_number() OVER best)::INT AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY item_row ORDER BY score DESC, doc_id) QUALIFY rank <= {OP12_TOP}
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP13_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS words FROM documents
),
words AS (SELECT row_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM docs),
runs AS (
    SELECT row_id, i, word || ' ' || lead(word) OVER w AS two,
        word || ' ' || lead(word) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w AS four
    FROM words WINDOW w AS (PARTITION BY row_id ORDER BY i)
),
phrases AS (SELECT * FROM (VALUES {", ".join(f"({_quoted(p)}, {_quoted(x)})" for p, x in licenses.PHRASES.items())}) t(phrase, label)),
places AS (SELECT row_id, i, label FROM runs JOIN phrases ON two = phrase OR four = phrase),
templates AS (
    SELECT template, label, regexp_extract_all({_LOWER}, '{_TERM}') AS words
    FROM (VALUES {", ".join(f"({n}, {_quoted(x)}, {_quoted(t)})" for n, (x, t) in enumerate(licenses.TEMPLATES))}) t(template, label, text)
),
template_words AS (
    SELECT template, label, len(words) AS n, unnest(words) AS word, unnest(range(len(words))) AS i FROM templates
),
template_runs AS (
    SELECT template, label, n, i,
        word || ' ' || lead(word) OVER w || ' ' || lead(word, 2) OVER w || ' ' || lead(word, 3) OVER w AS four
    FROM template_words WINDOW w AS (PARTITION BY template ORDER BY i)
),
hits AS (
    SELECT row_id, template, label, n, r.i - t.i AS diagonal, t.i AS place FROM runs r JOIN template_runs t USING (four)
),
diagonals AS (
    SELECT *, coalesce(diagonal - lag(diagonal) OVER w > greatest(1, {licenses.SLACK} * n), false)::INT AS apart
    FROM (SELECT DISTINCT row_id, template, n, diagonal FROM hits) WINDOW w AS (PARTITION BY row_id, template ORDER BY diagonal)
),
spans AS (SELECT *, sum(apart) OVER (PARTITION BY row_id, template ORDER BY diagonal) AS span FROM diagonals),
covered AS (
    SELECT row_id, label, span, count(DISTINCT covered_at)::DOUBLE / n AS covered
    FROM (SELECT row_id, template, label, n, span, unnest(range(place, place + 4)) AS covered_at FROM hits JOIN spans USING (row_id, template, n, diagonal))
    GROUP BY row_id, template, label, n, span
),
notices AS (SELECT * FROM covered WHERE covered >= {licenses.MIN_COVERED}),
base AS (
    SELECT row_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM places GROUP BY row_id
),
labelled AS (
    SELECT row_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT row_id, label FROM places UNION ALL SELECT row_id, label FROM notices) GROUP BY row_id
),
best AS (SELECT row_id, max(covered) AS covered, count(*) AS n_notices FROM notices GROUP BY row_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
    last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    greatest(coalesce(covered, 0), CASE WHEN n_base > 0 THEN {licenses.PHRASE_SCORE} ELSE 0 END)::DOUBLE AS score,
    coalesce(n_notices, 0)::BIGINT AS n_notices
FROM docs LEFT JOIN base USING (row_id) LEFT JOIN labelled USING (row_id) LEFT JOIN best USING (row_id)
"""

WORD_TOKENIZER = "word_bpe_49k.json"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sharding.hashed(docs.select("doc_id", F.octet_length("text").alias("n_bytes")), size=F.col("n_bytes"))
    return sharding.assign(rows, SHARD_BYTES).select("doc_id", F.col("bytes").alias("n_bytes"), "shard", "depth", "shard_bytes")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.small_batches(spark)
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.join(docs).select("doc_id", "class_id", "copies", "n_links")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.small_batches(spark)
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))
    spans = F.col("found_spans")
    base = F.filter(spans, lambda s: s["kind"] != "random")
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in secrets.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(spans).alias("spans")
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = common.new_folder(spark, "tokens")
    token_files.write_tokens(
        common.read_table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_TOKENIZER)
    )
    return token_files.read_tokens(spark, folder)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.small_batches(spark)
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, common.read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= toxicity.REJECT_AT).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.small_batches(spark)
    docs = common.read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", "text", packing.text_cluster().alias("own"), F.length("text").alias("length")
    )
    # Equal and similar texts are a cluster; a text without relatives is one of its own, a null text has none.
    related = F.coalesce(F.lower(F.hex("class_key")), "own")
    cluster = F.when(F.col("own").isNotNull(), related).alias("cluster")
    items = packing.number_rows(jaccard.join(docs).select("doc_id", "source", cluster, "length"), "items")
    # The row number, unlike doc_id, is unique; it is the key that pieces are joined back on.
    placed = common.stage(packing.pack(items, BIN_CHARS), "placed")
    return items.select("row_id", "doc_id", "source", "cluster").join(placed, "row_id").drop("row_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    return mixing.mix(docs, temperature=MIX_TEMPERATURE, seed=MIX_SEED)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = common.new_folder(spark, "warc")
    index = warc.write_archives(common.read_table(spark, sf_dir, "pages"), folder)
    return warc.read_records(index, folder).drop("url", "payload")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k.search(vectors, F.col("vec_id") % 50 == 0, TOP_K)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(common.read_table(spark, sf_dir, "documents"))


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """Texts as op11 looks at them: by the checksum of its id, a document's words may go on periodically."""
    import zlib

    def planted(number: str | None, own: str) -> str:
        h = zlib.crc32(number.encode()) if number is not None else 1
        words = own.encode("utf-8", "surrogatepass").split() if h % 10 == 0 else []
        if not words:
            return own
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        periodic = words[:a] + [words[a + i % p] for i in range(n - a)]
        return b" ".join(periodic).decode("utf-8", "surrogatepass")

    @F.pandas_udf("string")
    def plant(numbers: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([planted(number, own) for number, own in zip(numbers, texts)], dtype="object")

    return plant(doc_id.cast("string"), text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.small_batches(spark)
    docs = common.read_table(spark, sf_dir, "documents")
    text = with_planted_period(F.col("doc_id"), common.text_or_empty())
    found = runs.collapse(docs.select("doc_id", text.alias("text")), hashed=True)
    order = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shortness"), r["start"], r["period"])))
    best = F.get(order, F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        (-best["shortness"]).alias("length"),
        best["period"].alias("period"),
        F.floor(-1000 * best["shortness"] / best["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.small_batches(spark)
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    items = common.read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    return lexical.search(docs, items, OP12_TOP)


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    # File and position name a row for good, so that nothing has to be staged.
    docs = common.read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.xxhash64("_metadata.file_path").alias("row_file"), F.col("_metadata.row_index").alias("row_at")
    )
    found = licenses.scan(docs, ["row_file", "row_at"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["at"])).alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["at"])).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.size("notices").cast("long").alias("n_notices"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_secrets": op3_secrets,
        "op4_token_files": op4_token_files,
        "op5_toxicity": op5_toxicity,
        "op6_packing": op6_packing,
        "op7_mixing": op7_mixing,
        "op8_warc": op8_warc,
        "op9_top_k": op9_top_k,
        "op10_quality": op10_quality,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_lexical_search": op12_lexical_search,
        "op13_licenses": op13_licenses,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_sharding": OP1_SQL,
        "op7_mixing": OP7_SQL,
        "op8_warc": OP8_SQL,
        "op9_top_k": OP9_SQL,
        "op10_quality": OP10_SQL,
        "op11_periodic_runs": OP11_SQL,
        "op12_lexical_search": OP12_SQL,
        "op13_licenses": OP13_SQL,
    }
