"""DuckDB SQL for the queries that SQL can express."""

CHAT = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n,
    length('<|im_start|>') + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\1\\|', 'g')) + 1
      + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1 AS width
  FROM given
), summed AS (
  SELECT *, sum(width) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(upto) FILTER (role = 'assistant' OR i = n))::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""

TOPK = """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

_POLYNOMIAL = 0xEDB88320

SHARDS = rf"""
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, {_POLYNOMIAL}) ELSE c >> 1 END)) AS crc
), d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(octet_length(encode(text)), 0) + 8 AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::HUGEINT AS k,
    xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, bits
), walk AS (
  SELECT r, k, 0::BIGINT AS place, 0::BIGINT AS ahead FROM d
  UNION ALL
  SELECT r, k2, ahead, floor((ahead + 1) * (2147483648::DOUBLE / ((k2 >> 33) + 1)::DOUBLE))::BIGINT
  FROM (SELECT r, ahead, ((k * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT) AS k2 FROM walk WHERE ahead < 25)
), placed AS (
  SELECT r, max(place) FILTER (place < 24) AS shard, max(place) AS grown FROM walk WHERE place < 25 GROUP BY r
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown::INTEGER AS grown_shard
FROM d JOIN placed USING (r)
"""

MIX = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS w
  FROM d GROUP BY source
), level AS (
  SELECT 0 AS step, 0::DOUBLE AS share
  UNION ALL
  SELECT step + 1, (sum(source_size) - sum(CASE WHEN 3 * source_size < share * w THEN 3 * source_size ELSE 0 END))::DOUBLE
    / sum(CASE WHEN 3 * source_size < share * w THEN 0 ELSE w END)::DOUBLE
  FROM level, s WHERE step < 60 GROUP BY step, share
), goal AS (
  SELECT source, source_size, least((3 * source_size)::DOUBLE, share * w) AS target FROM s, level WHERE step = 60
), placed AS (
  SELECT d.*, source_size, target, floor(target + 0.5)::BIGINT AS budget,
    sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS earlier
  FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source
)
SELECT doc_id, size, source_size, target, source,
  CASE WHEN source_size = 0 THEN 0
    ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - earlier)) END::BIGINT AS taken
FROM placed
"""


def rules_sql(rules) -> str:
    """The counts, the sketches and the fences of the quality rules, with the values of ``rules``."""
    rates = {
        "chars_per_word": "word_chars / nullif(n_words, 0)",
        "symbols_per_word": "n_symbols / nullif(n_words, 0)",
        "dup_lines_per_line": "n_dup_lines / nullif(n_lines, 0)",
        "repeated_per_word": "n_repeat_words / nullif(n_words, 0)",
    }
    counts = {"symbols_per_word": "n_symbols", "dup_lines_per_line": "n_dup_lines", "repeated_per_word": "n_repeat_words"}
    zero = -(1 << 62)
    gamma, step, reach = rules.gamma, rules.log_gamma, f"{rules.reach!r}::DOUBLE"
    value = f"CASE WHEN bucket = {zero} THEN 0.0 ELSE pow({gamma!r}::DOUBLE, bucket::DOUBLE) * {2 / (1 + gamma)!r}::DOUBLE END"

    def fences(table: str, sketch: str, group: str) -> str:
        keys = f"{group}, metric" if group else "metric"
        return f"""{table} AS (
  SELECT *, CASE WHEN metric = 'chars_per_word' THEN q1 - {reach} * (q3 - q1) END AS low,
    CASE WHEN metric = 'chars_per_word' THEN q3 + {reach} * (q3 - q1) WHEN metric LIKE '%per%' THEN usual * sqrt(share) * {reach} ELSE little * {rules.few!r}::DOUBLE END AS high
  FROM (SELECT {keys}, min({value}) FILTER (4 * upto >= docs) AS q1, min({value}) FILTER (4 * upto >= 3 * docs) AS q3,
      min({value}) FILTER (bucket > {zero} AND 10 * (upto - zero) >= 5 * (docs - zero)) AS usual,
      min({value}) FILTER (bucket > {zero} AND 10 * (upto - zero) >= docs - zero) AS little, (max(docs) - max(zero))::DOUBLE / max(docs)::DOUBLE AS share
    FROM (SELECT {keys}, bucket, sum(n) OVER (PARTITION BY {keys} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {keys}) AS docs,
        coalesce(sum(n) FILTER (bucket = {zero}) OVER (PARTITION BY {keys}), 0) AS zero FROM {sketch})
    GROUP BY {keys}))"""

    seen = " UNION ALL ".join(f"SELECT lang, source, '{n}' AS metric, {n} AS rate FROM rated WHERE {n} IS NOT NULL" for n in rates)
    seen += "".join(f" UNION ALL SELECT lang, source, '{c}', {c}::DOUBLE FROM rated WHERE n_words > 0" for c in counts.values())
    wide = f"(1 + {rules.short!r}::DOUBLE / n_words)"
    few = lambda c: f"{c} <= (SELECT high FROM used f WHERE f.metric = '{c}' AND f.lang IS NOT DISTINCT FROM rated.lang AND f.source IS NOT DISTINCT FROM rated.source)"
    inside = lambda n: f"{n} <= high * {wide} OR {few(counts[n])}" if n != "chars_per_word" else f"{n} <= (low + high) / 2 + (high - low) / 2 * {wide} AND {n} >= (low + high) / 2 - (high - low) / 2 * {wide}"
    checks = " AND ".join(
        f"coalesce((SELECT {inside(n)} FROM used WHERE metric = '{n}' AND used.lang IS NOT DISTINCT FROM rated.lang AND used.source IS NOT DISTINCT FROM rated.source), true)"
        for n in rates
    )
    return rf"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS win FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM split)
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest(range(i, i + 5)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY r, win) AS times FROM windows) WHERE times > 1)
  GROUP BY r
), counted AS (
  SELECT r, doc_id, lang, source, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)
), rated AS (
  SELECT *, {", ".join(f"{expression} AS {n}" for n, expression in rates.items())},
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM counted
), sketch AS (
  SELECT lang, source, metric, CASE WHEN rate > 0 THEN ceil(ln(rate) / {step!r}::DOUBLE)::BIGINT ELSE {zero} END AS bucket, count(*) AS n
  FROM ({seen}) GROUP BY ALL
), every AS (SELECT metric, bucket, sum(n)::HUGEINT AS n FROM sketch GROUP BY ALL),
lang_own AS (SELECT lang, metric, bucket, sum(n)::HUGEINT AS n FROM sketch GROUP BY ALL),
by_lang AS (
  SELECT lang, metric, bucket, sum(n)::HUGEINT AS n FROM (
    SELECT lang, metric, bucket, n * docs AS n FROM lang_own JOIN (SELECT metric, sum(n)::HUGEINT AS docs FROM every GROUP BY metric) USING (metric)
    UNION ALL SELECT lang, metric, bucket, n * {rules.prior_docs} FROM every JOIN (SELECT DISTINCT lang, metric FROM sketch) USING (metric))
  GROUP BY ALL),
own AS (
  SELECT lang, source, metric, bucket, sum(n)::HUGEINT AS n FROM (
    SELECT s.lang, source, s.metric, bucket, n * docs AS n FROM sketch s
      JOIN (SELECT lang, metric, sum(n)::HUGEINT AS docs FROM by_lang GROUP BY ALL) t ON s.lang IS NOT DISTINCT FROM t.lang AND s.metric = t.metric
    UNION ALL SELECT g.lang, g.source, g.metric, bucket, n * {rules.prior_docs} FROM (SELECT DISTINCT lang, source, metric FROM sketch) g
      JOIN by_lang b ON g.lang IS NOT DISTINCT FROM b.lang AND g.metric = b.metric)
  GROUP BY ALL),
{fences("own_fences", "own", "lang, source")}, {fences("lang_fences", "by_lang", "lang")}, {fences("all_fences", "every", "")}, used AS (
  SELECT o.lang, o.source, o.metric, greatest(o.low, l.low) AS low,
    CASE WHEN o.metric = 'chars_per_word' THEN least(o.high, l.high) ELSE least(o.high, l.high, a.high) END AS high
  FROM own_fences o JOIN lang_fences l ON o.lang IS NOT DISTINCT FROM l.lang AND o.metric = l.metric JOIN all_fences a ON o.metric = a.metric
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {checks} AS kept
FROM rated
"""


def licenses_sql(templates, least: float) -> str:
    """Likeness of every line, paragraph and text to the templates, by sets of word bigrams."""
    quoted = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in templates)
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = "regexp_extract_all(" + lower + ", '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    with_word = "list_filter(string_split({}, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]'))"
    return f"""
WITH template AS (
  SELECT name, {grams} AS g FROM (SELECT name, {words.format("text")} AS w FROM (VALUES {quoted}) t(name, text))
), d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), paragraph AS (
  SELECT r, p, len({with_word.format("p")}) AS n FROM (SELECT r, unnest(string_split_regex(text, '\\n([\\x20\\x09\\x0B-\\x0D]*\\n)+')) AS p FROM d)
), unit AS (
  SELECT r, unnest({with_word.format("text")}) AS u FROM d
  UNION ALL SELECT r, p FROM paragraph WHERE n > 1
  UNION ALL SELECT r, text FROM d WHERE r IN (SELECT r FROM paragraph WHERE n > 0 GROUP BY r HAVING count(*) > 1)
), told AS (
  SELECT r, u, {grams} AS g FROM (SELECT r, u, {words.format("u")} AS w FROM unit)
), scored AS (
  SELECT r, row_number() OVER () AS k, g FROM told WHERE len(g) > 0
), hit AS (
  SELECT r, k, name, 2 * len(list_intersect(scored.g, template.g)) / (len(scored.g) + len(template.g)) AS score
  FROM scored JOIN template ON 2 * least(len(scored.g), len(template.g)) >= {least!r} * (len(scored.g) + len(template.g))
), best AS (
  SELECT r, k, name, score FROM hit WHERE score >= {least!r}
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, name) = 1
), found AS (
  SELECT r, first(name ORDER BY score DESC, name) AS license, max(score) AS license_score, count(*) AS n_matches,
    array_to_string(list_sort(list_distinct(list(name))), ',') AS licenses
  FROM best GROUP BY r
)
SELECT doc_id, license, license_score, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses FROM d LEFT JOIN found USING (r)
"""


_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
keyed AS (SELECT *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') AS k FROM split),
common AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM (SELECT *, k IN (SELECT k FROM common) AS gone FROM keyed) GROUP BY r, doc_id
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}') AS ts FROM documents
), held AS (SELECT r, doc_id, len(ts)::BIGINT AS n, ts FROM d WHERE len(ts) > 0),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_words FROM held),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM held) GROUP BY r, t),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, corpus GROUP BY t, n_docs),
items AS (
  SELECT q, item_id, unnest(list_distinct(ts)) AS t FROM (
    SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}') AS ts FROM benchmark)
), scored AS (
  SELECT q, any_value(item_id) AS item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_words))))::BIGINT AS score
  FROM items JOIN tf USING (t) JOIN w USING (t) JOIN held USING (r), corpus GROUP BY q, r
)
SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM scored JOIN (SELECT r, doc_id FROM held) USING (r) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) <= 50
"""
