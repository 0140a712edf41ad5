"""Registered queries of the operators: each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_minhash_near_dedup(spark, sf_dir):
    from tributary.llm.minhash import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op2_secret_blob_ledger(spark, sf_dir):
    from tributary.llm.secrets import secrets
    return secrets(_table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))


@_query
def op6_quality_suffix_array(spark, sf_dir):
    from tributary.llm.quality import quality
    return quality(_table(spark, sf_dir, "documents"))


@_query
def op10_token_counts(spark, sf_dir):
    import public_tokenizers
    from tributary.llm import tokens
    return tokens.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(tokens.MODEL))


@_query
def op3_run_length_index_dedup(spark, sf_dir):
    from tributary.llm.substrings import remove_repeats
    return remove_repeats(_table(spark, sf_dir, "documents"))


@_query
def op4_best_fit_packing(spark, sf_dir):
    from tributary.llm.packing import pack
    return pack(_table(spark, sf_dir, "documents"))


@_query
def op5_greedy_string_tiling(spark, sf_dir):
    from tributary.llm.tiling import contaminated
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _captures(pages: DataFrame) -> DataFrame:
    """Pages as captures; the fetch day is a function of the page id."""
    return pages.select("page_id", "url", F.expr("date_add(date'2024-01-01', cast(pmod(page_id * 37, 365) as int))").alias("fetched"))


def _list_log(pages: DataFrame) -> DataFrame:
    """A dated list over all hosts, parent domains and first path segments of the pages: each entry is
    added, removed and added again on days its hash gives."""
    from tributary.llm.urls import host
    h = host(F.col("url"))
    segment = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)
    entries = (pages.where(h.isNotNull()).select(F.explode(F.array(
        h, F.array_join(F.slice(F.split(h, r"\."), -F.least(F.size(F.split(h, r"\.")), F.lit(3)), 3), "."),
        F.concat(h, F.lit("/"), segment))).alias("entry")).distinct())
    n = F.conv(F.substring(F.md5("entry"), 1, 6), 16, 10).cast("bigint")
    return entries.select("entry", n.alias("n")).selectExpr(
        "entry", "explode(array("
        "struct(cast(n % 300 as int) as day, 'add' as action), "
        "struct(cast(n % 300 + 15 + (n div 300) % 45 as int) as day, 'remove' as action), "
        "struct(cast(n % 300 + 120 + (n div 7) % 60 as int) as day, 'add' as action))) as e").selectExpr(
        "entry", "date_add(date'2024-01-01', e.day) as at", "e.action as action")


@_query
def op7_temporal_url_filter(spark, sf_dir):
    from tributary.llm.urls import blocked
    pages = _table(spark, sf_dir, "pages")
    return blocked(_captures(pages), _list_log(pages))


ORACLE_SQL["op7_temporal_url_filter"] = r"""
WITH captures AS (
  SELECT row_number() OVER () AS rn, page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 365 AS INTEGER) AS fetched,
         nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.$', ''), '') AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS segment
  FROM pages),
entries AS (
  SELECT host AS entry FROM captures WHERE host IS NOT NULL
  UNION SELECT array_to_string(string_split(host, '.')[-3:], '.') FROM captures WHERE host IS NOT NULL
  UNION SELECT host || '/' || segment FROM captures WHERE host IS NOT NULL),
numbered AS (SELECT entry, CAST('0x' || substr(md5(entry), 1, 6) AS BIGINT) AS n FROM entries),
log AS (
  SELECT entry, n % 300 AS day, 'add' AS action FROM numbered
  UNION ALL SELECT entry, n % 300 + 15 + (n // 300) % 45, 'remove' FROM numbered
  UNION ALL SELECT entry, n % 300 + 120 + (n // 7) % 60, 'add' FROM numbered),
one AS (SELECT entry, DATE '2024-01-01' + CAST(day AS INTEGER) AS day_at, max(action) AS action FROM log GROUP BY entry, day),
spans AS (SELECT entry, action, day_at AS since, lead(day_at) OVER (PARTITION BY entry ORDER BY day_at) AS until FROM one),
candidates AS (
  SELECT rn, fetched, host || '/' || segment AS entry FROM captures WHERE segment <> ''
  UNION
  SELECT rn, fetched, array_to_string(string_split(host, '.')[i:], '.')
  FROM (SELECT rn, fetched, host, unnest(range(1, greatest(len(string_split(host, '.')), 2))) AS i FROM captures)),
hits AS (
  SELECT c.rn, count(*) AS n, min(c.entry) AS first_entry
  FROM candidates c JOIN spans s ON c.entry = s.entry AND s.action = 'add'
   AND c.fetched >= s.since AND (s.until IS NULL OR c.fetched < s.until) GROUP BY c.rn)
SELECT c.page_id, c.url, c.fetched, coalesce(h.n, 0) AS n_entries, h.first_entry, coalesce(h.n, 0) > 0 AS blocked
FROM captures c LEFT JOIN hits h USING (rn)"""


@_query
def op9_line_hash_dedup(spark, sf_dir):
    from tributary.llm.lines import repeated_units
    return repeated_units(_table(spark, sf_dir, "documents"))


ORACLE_SQL["op9_line_hash_dedup"] = r"""
WITH docs AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text, CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS digest FROM documents),
lines AS (
  SELECT rn, doc_id, digest, line, i AS unit,
         sum(length(line) + 1) OVER (PARTITION BY rn ORDER BY i) - length(line) - 1 AS start
  FROM (SELECT rn, doc_id, digest, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
        FROM (SELECT rn, doc_id, digest,
                     string_split(regexp_replace(text, '([.!?])[ \t\v\f\r]', '\1' || chr(10), 'g'), chr(10)) AS parts FROM docs))),
units AS (
  SELECT rn, doc_id, digest, unit, start, start + length(line) AS stop,
         trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\t\n\v\f\r ]+', ' ', 'g'), ' ') AS norm
  FROM lines),
counted AS (SELECT *, len(string_split(norm, ' ')) AS words FROM units WHERE norm <> ''),
summed AS (SELECT *, sum(words) OVER w AS upto, sum(words) OVER (PARTITION BY rn) AS total
           FROM counted WINDOW w AS (PARTITION BY rn ORDER BY unit)),
around AS (  -- a unit has a word at least, so eight units are enough on either side
  SELECT *, list({'upto': upto, 'words': words, 'norm': norm, 'unit': unit}) OVER (PARTITION BY rn ORDER BY unit ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS after,
         list({'upto': upto, 'words': words, 'norm': norm, 'unit': unit}) OVER (PARTITION BY rn ORDER BY unit ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS prior,
         list(norm) OVER (PARTITION BY rn ORDER BY unit ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS every
  FROM summed),
passages AS (
  SELECT rn, doc_id, digest, unit AS place, start, stop, norm AS passage FROM around WHERE words >= 8
  UNION ALL
  SELECT rn, doc_id, digest, min(unit) OVER (PARTITION BY rn), start, stop, array_to_string(every, ' ') FROM around WHERE words < 8 AND total < 8
  UNION ALL
  SELECT rn, doc_id, digest, unit, start, stop, array_to_string([x.norm FOR x IN after IF x.upto - x.words < upto - words + 8], ' ')
  FROM around WHERE words < 8 AND total - upto + words >= 8
  UNION ALL
  SELECT rn, doc_id, digest, list_min([x.unit FOR x IN prior IF x.upto > upto - 8]), start, stop,
         array_to_string([x.norm FOR x IN prior IF x.upto > upto - 8], ' ')
  FROM around WHERE words < 8 AND upto >= 8),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY passage ORDER BY doc_id NULLS LAST, digest, place) AS nth FROM passages),
gone AS (SELECT DISTINCT rn, start, stop FROM ranked WHERE nth > 1),
per AS (SELECT rn, count(*) AS n_removed, sum(stop - start) AS removed_chars,
               string_agg(start || ':' || stop, ',' ORDER BY start) AS removed FROM gone GROUP BY rn),
sizes AS (SELECT rn, count(*) AS n_units FROM counted GROUP BY rn)
SELECT d.doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
       CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars, coalesce(removed, '') AS removed
FROM docs d LEFT JOIN sizes USING (rn) LEFT JOIN per USING (rn)"""


@_query
def op8_wrapper_induction(spark, sf_dir):
    from tributary.llm.html import main_text
    return main_text(_table(spark, sf_dir, "pages"))


@_query
def op12_lockstep_alignment(spark, sf_dir):
    import public_tokenizers
    from tributary.llm import alignment
    return alignment.alignment(_table(spark, sf_dir, "documents"), public_tokenizers.path(alignment.TOKENIZER_A),
                               public_tokenizers.path(alignment.TOKENIZER_B))


@_query
def op11_stripes_collocations(spark, sf_dir):
    from tributary.llm.phrases import collocations
    return collocations(_table(spark, sf_dir, "documents"))


ORACLE_SQL["op11_stripes_collocations"] = r"""
WITH pieces AS (
  SELECT lang, unnest(string_split_regex(low, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents)),
worded AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM pieces),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM worded GROUP BY lang),
counts AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
        FROM worded, (SELECT unnest(range(1, 6)) AS k) WHERE len(words) >= k)
  GROUP BY ALL HAVING count(*) >= 100),
candidates AS (
  SELECT c.* FROM counts c WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM counts o WHERE o.lang = c.lang AND o.k > c.k AND 100 * o.a >= 100 * c.a
      AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (
  SELECT c.lang, c.phrase, c.a, j, l.a AS l, r.a AS r, t.n,
         CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM (SELECT *, string_split(phrase, ' ') AS words, unnest(range(1, k)) AS j FROM candidates) c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:j], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[j + 1:], ' ')
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""


@_query
def op13_balanced_label_propagation(spark, sf_dir):
    from tributary.llm.sharding import shard_documents
    return shard_documents(_table(spark, sf_dir, "documents"))
