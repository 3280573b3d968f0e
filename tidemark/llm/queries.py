"""Registered queries of the corpus operators: thin digests of what the operators return."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    crf, decontaminate, divergence, langid, linededup, mixing, sanitise, simhash, substring, tokencount, tokenfile,
    urlfilter, vectorcodes,
)
from tidemark.llm.common import shared_path, store
from tidemark.scale import broadcast_if_small

TOKENIZER = "word_bpe_49k.json"  # drops white space and never merges across it
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return langid.identify(table(spark, sf_dir, "documents"), held_out)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return crf.judge(docs, crf.fit(docs, table(spark, sf_dir, "labels"))).drop("text")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("n_copies") * F.col("size")).alias("taken"))


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urlfilter.judge_urls(table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), END_ID, by_word=True)
    tokens = tokenfile.read_tokens(spark, path)
    return tokenfile.digests(tokenfile.with_start(tokens, tokens))


def op9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op10_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own for each call, so that every call answers for the whole table
    cache = shared_path(spark, "token-counts")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = tokencount.count_tokens(docs, cache, public_tokenizers.path(TOKENIZER), True, tokencount.folded)
    return found.withColumn("over_limit", F.col("n_tokens") > 2048)


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = vectorcodes.usable(table(spark, sf_dir, "embeddings"))
    books = vectorcodes.fit(kept)
    coded = store(vectorcodes.encode(kept, books), "codes")
    totals = broadcast_if_small(store(vectorcodes.label_totals(coded), "label-totals"))
    rows = coded.join(totals, coded["label"].eqNullSafe(totals["label"]))
    code, digest = F.lower(F.hex("code")).alias("code"), F.lit(books.digest()).alias("codebooks_sha256")
    return rows.select("vec_id", code, "error", "label_error", digest)


def op12_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.find(table(spark, sf_dir, "documents"))
    counts = [sanitise.count_of(F.col("spans"), k).alias(f"n_{sanitise.KINDS[k]}") for k in range(sanitise.TERM)]
    base = sanitise.listed(F.filter("spans", lambda s: s["kind"] < sanitise.TERM))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), sanitise.listed(F.col("spans")).alias("spans"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_langid, op2_simhash, op3_quality, op4_mixing, op5_substring, op6_lines, op7_urls, op8_tokens,
              op9_leaks, op10_counts, op11_codes, op12_private, op13_divergence)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = r"[\x20\x09-\x0D]"
_LAST = (1 << 63) - 1

MIX_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), classed AS (
  SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS w FROM docs
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank
  FROM docs GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 2 * source_size AS cap FROM sources
), filled AS (
  SELECT *, sum(cap) OVER up AS topped, sum(weight) OVER up AS used,
    (SELECT 1.5 * sum(source_size)::DOUBLE FROM sources) AS wanted, (SELECT sum(weight) FROM weighed) AS weights
  FROM weighed WINDOW up AS (ORDER BY cap / weight, rank)
), rated AS (
  SELECT *, (wanted - (topped - cap)::DOUBLE) / (weights - (used - weight))::DOUBLE AS rate FROM filled
), pace AS (
  SELECT arg_min(rate, (cap / weight, rank)) AS rate FROM rated WHERE rate * weight < cap
), aims AS (
  SELECT source, rank, source_size, least(cap::DOUBLE, coalesce(pace.rate * weight, cap::DOUBLE)) AS target FROM rated, pace
), classes AS (
  SELECT rank, source_size, target, w, sum(size)::BIGINT AS words
  FROM classed JOIN aims ON classed.source IS NOT DISTINCT FROM aims.source GROUP BY ALL
), steps AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY rank ORDER BY w DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above,
    sum(w * words) OVER (PARTITION BY rank ORDER BY w DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS below FROM classes
), slopes AS (
  SELECT *, CASE WHEN below > 0 THEN (target - (above * 2)::DOUBLE) / below::DOUBLE END AS slope FROM steps
), chosen AS (
  SELECT rank, arg_max(slope, w) AS c FROM slopes WHERE slope * w <= 2 GROUP BY rank
), rates AS (
  SELECT slopes.*, CASE WHEN w > 0 THEN least(2.0::DOUBLE, coalesce(c * w, 2.0::DOUBLE)) ELSE 0 END AS copies
  FROM slopes LEFT JOIN chosen USING (rank)
), parts AS (
  SELECT *, floor(copies)::BIGINT AS certain, copies - floor(copies) AS p,
    target - sum(floor(copies)::BIGINT * words) OVER (PARTITION BY rank)::DOUBLE AS lacking FROM rates
), drawn AS (
  SELECT classed.*, parts.rank, certain, p, lacking, parts.source_size, parts.target,
    (('0x' || md5('mix:' || doc_id)[1:12])::BIGINT * 2 + 1) / (1::BIGINT << 49)::DOUBLE AS u
  FROM classed JOIN aims ON classed.source IS NOT DISTINCT FROM aims.source
  JOIN parts ON parts.rank = aims.rank AND parts.w = classed.w
), ordered AS (
  SELECT *, CASE WHEN p > 0 THEN sum(CASE WHEN p > 0 THEN size ELSE 0 END) OVER (
    PARTITION BY rank, p > 0 ORDER BY (u / (1 - u)) / (p / (1 - p)), doc_id ROWS UNBOUNDED PRECEDING) END AS through FROM drawn
)
SELECT doc_id, size, source_size, target,
  (size * (certain + CASE WHEN p > 0 AND 2 * through - size < 2 * lacking THEN 1 ELSE 0 END))::BIGINT AS taken FROM ordered
"""

SUBSTRING_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {_LAST}) AS ord,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), places AS (
  SELECT r, ord, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50
), windows AS (
  SELECT r, ord, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM places
), repeated AS (
  SELECT r, i FROM (SELECT *, min(ord) OVER (PARTITION BY h) AS low FROM windows) WHERE ord > low
), gone AS (
  SELECT r, list(DISTINCT k) AS ks FROM (SELECT r, unnest(range(i, i + 50)) AS k FROM repeated) GROUP BY r
), left_over AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed,
    CASE WHEN ks IS NULL THEN w ELSE list_select(w, list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(ks, k))) END AS kept
  FROM docs LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM left_over
"""

LINES_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, {_LAST}) AS ord, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
  SELECT r, doc_id, ord, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM docs
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS key FROM lines
), judged AS (
  SELECT *, length(key) >= 10 AND ord > min(ord) OVER (PARTITION BY key) AS gone FROM keyed
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM judged GROUP BY r
"""

_TERM = "'(^|[^a-z0-9])(' || {} || ')([^a-z0-9]|$)'"
URLS_SQL = f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages
), rules (rule, host, path, verdict) AS (
  VALUES {", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for r, v in urlfilter.RULES)}
), soft (term) AS (VALUES {", ".join(f"('{t}')" for t in urlfilter.SOFT)}
), ruled AS (
  SELECT page_id, arg_min(rule, (-length(rule), rule)) AS rule, arg_min(verdict, (-length(rule), rule)) AS verdict
  FROM parts p JOIN rules r ON (p.host = r.host OR suffix(p.host, '.' || r.host)) AND prefix(p.path, r.path) GROUP BY page_id
), counted AS (
  SELECT page_id, count(*) AS n FROM parts JOIN soft ON regexp_matches(low, {_TERM.format("term")}) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE
  WHEN regexp_matches(low, {_TERM.format("'" + "|".join(urlfilter.STRICT) + "'")}) OR coalesce(n, 0) >= {urlfilter.SOFT_LIMIT}
  THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN ruled USING (page_id) LEFT JOIN counted USING (page_id)
"""

LEAKS_SQL = f"""
WITH item_words AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), item_places AS (
  SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS h FROM item_places
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), places AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
), hits AS (
  SELECT r, i, n, item_id FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS h FROM places) JOIN windows USING (n, h)
), hit_words AS (
  SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hits) GROUP BY r
), found AS (
  SELECT r, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids FROM hits GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN found USING (r)
"""



def _codes_sql(rounds: int = 6) -> str:
    """Plain distances of all parts to all entries; a recursive query written out, as each step groups."""
    steps = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::HUGEINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, p, v[p * m + 1:p * m + m] AS x, m FROM kept, range(8) t(p), (SELECT max(len(v)) // 8 AS m FROM kept)
), book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM parts WHERE r <= 16)"""
    for k in range(rounds + 1):
        steps += f""", near{k} AS MATERIALIZED (
  SELECT r, p, min(d) AS d, arg_min(e, (d, e)) AS e FROM (
    SELECT r, parts.p, e, list_sum(list_transform(range(1, m + 1), lambda i: (parts.x[i] - b.x[i]) * (parts.x[i] - b.x[i]))) AS d
    FROM parts JOIN book{k} b USING (p)) GROUP BY r, p
)"""
        if k < rounds:
            steps += f""", sums{k} AS (
  SELECT p, e, i, sum(y) AS s, count(*) AS n
  FROM (SELECT p, e, unnest(x) AS y, unnest(range(len(x))) AS i FROM parts JOIN near{k} USING (r, p)) GROUP BY ALL
), book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(t.x, b.x) AS x FROM book{k} b LEFT JOIN (
    SELECT p, e, list(s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END ORDER BY i) AS x FROM sums{k} GROUP BY p, e) t USING (p, e)
)"""
    return steps + f""", coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM kept JOIN near{rounds} USING (r) GROUP BY r, vec_id, label
), digest AS (
  SELECT sha256(string_agg(list_aggregate(x, 'string_agg', ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, digest
"""


CODES_SQL = _codes_sql()

_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
_LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_PATTERNS = {
    "email": (_EMAIL, f"translate(m, '{_UPPER}', '{_LOWER}')"),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "CASE WHEN len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3"
        " OR (length(ltrim(x, '0')) = 3 AND ltrim(x, '0') > '255'))) = 0 THEN m END",
    ),
    "card": (
        r"[0-9]([\x20-]?[0-9])+",
        "CASE WHEN length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(length(d)), lambda j:"
        " CASE WHEN j % 2 = 0 THEN d[length(d) - j]::INT ELSE 2 * d[length(d) - j]::INT // 10 + 2 * d[length(d) - j]::INT % 10 END)) % 10 = 0 THEN d END",
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "CASE WHEN length(d) BETWEEN 9 AND 15 THEN '+' || d END"),
}


def _words_sql(text: str) -> str:
    return f"regexp_extract_all(translate(regexp_replace({text}, '{_EMAIL}', ' ', 'g'), '{_UPPER}', '{_LOWER}'), '{_LETTERS}')"


def _placed_sql(name: str, rows: str, pattern: str) -> str:
    """Matches with their offsets and the text before and after each."""
    return f"""{name}_cut AS (
  SELECT *, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gs FROM {rows}
), {name}_each AS (
  SELECT r, base, unnest(ms) AS m, unnest(range(len(ms))) AS i, unnest(gs[1:len(ms)]) AS g, unnest(gs[2:]) AS after FROM {name}_cut
), {name}_at AS (
  SELECT *, base + (sum(length(g) + length(m)) OVER (PARTITION BY r, base ORDER BY i))::BIGINT - length(m) AS start FROM {name}_each
)"""


def _private_sql() -> str:
    kinds = ", ".join(_placed_sql(k, "docs", p) for k, (p, _) in _PATTERNS.items())
    rows = " UNION ALL ".join(
        f"SELECT r, {n} AS kind, start, start + length(m) AS stop, {value} AS value, g, after"
        f" FROM (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS d FROM {k}_at)"
        for n, (k, (_, value)) in enumerate(_PATTERNS.items())
    )
    return f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, 0 AS base FROM documents
), {kinds}, base AS MATERIALIZED (
  SELECT * FROM ({rows}) WHERE value IS NOT NULL
), beside AS (
  SELECT DISTINCT r, kind, value, unnest(list_concat({_words_sql("g")}[-8:], {_words_sql("after")}[:8])) AS term FROM base
), near AS (
  SELECT term, max(n) AS near FROM (
    SELECT kind, value, term, count(*) AS n FROM beside JOIN docs USING (r) GROUP BY ALL HAVING count(DISTINCT t) >= 3) GROUP BY term
), held AS (
  SELECT term, count(*) AS n FROM (SELECT DISTINCT r, unnest({_words_sql("t")}) AS term FROM docs) SEMI JOIN near USING (term) GROUP BY term
), terms AS (
  SELECT term, CASE WHEN 2 * near >= n THEN 4 ELSE 5 END AS kind FROM near JOIN held USING (term) WHERE 4 * near >= n
), outside AS (
  SELECT r, t, start + length(m) AS base FROM (
    SELECT r, after AS t, m, start FROM email_at UNION ALL SELECT r, string_split_regex(t, '{_EMAIL}')[1], '', 0 FROM docs)
), {_placed_sql("word", "outside", _LETTERS)}, spans AS (
  SELECT r, kind, start, stop FROM base UNION ALL
  SELECT r, kind, start, start + length(m) FROM word_at JOIN terms ON term = translate(m, '{_UPPER}', '{_LOWER}')
), listed AS (
  SELECT r, kind, start, ['email', 'ip', 'card', 'phone', 'term', 'general'][kind + 1] || ':' || start || ':' || stop AS s FROM spans
)
SELECT any_value(doc_id) AS doc_id, {", ".join(f"count(*) FILTER (WHERE kind = {n}) AS n_{k}" for n, k in enumerate(_PATTERNS))},
  sha256(coalesce(string_agg(s, ',' ORDER BY start, kind) FILTER (WHERE kind < 4), '')) AS base_sha256,
  coalesce(string_agg(s, ',' ORDER BY start, kind), '') AS spans
FROM docs LEFT JOIN listed USING (r) GROUP BY r
"""


PRIVATE_SQL = _private_sql()

DIVERGENCE_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_LETTERS}') AS w FROM documents
), words AS MATERIALIZED (
  SELECT r, lang, source, unnest(w) AS term FROM docs
), kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS total FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), held AS (
  SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, source, sum(c) AS n FROM held GROUP BY ALL
), shares AS MATERIALIZED (
  SELECT lang, source, term, coalesce(c, 0) AS c,
    (1 + (1000000000::HUGEINT * (coalesce(c, 0) + 1)) // (coalesce(sizes.n, 0) + v))::BIGINT AS p,
    (1 + (1000000000::HUGEINT * (total + 1)) // (langs.n + v))::BIGINT AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN sizes USING (lang, source) LEFT JOIN held USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE c > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""

# A trained model (1, 3), bit operations over all pairs (2) or a tokenizer (8, 10) decide the others.
SQL = {
    "op4_mixing": MIX_SQL, "op5_substring": SUBSTRING_SQL, "op6_lines": LINES_SQL, "op7_urls": URLS_SQL,
    "op9_leaks": LEAKS_SQL, "op11_codes": CODES_SQL, "op12_private": PRIVATE_SQL, "op13_divergence": DIVERGENCE_SQL,
}
