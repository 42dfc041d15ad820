"""One query per operator, each over its whole table, and the same result as SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    collocations,
    exact_dedup,
    html_text,
    mixing,
    packing,
    quality_rules,
    secrets,
    sentence_spans,
    simhash,
    spelling,
    spotsigs,
    suffix_dedup,
    url_filter,
)
from millrace.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_pareto_mix(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query
def op2_hilbert_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


@query
def op3_url_filter(spark, sf):
    return url_filter.judge(table(spark, sf, "pages"), url_filter.labelled_urls(spark))


@query
def op4_quality_rules(spark, sf):
    return quality_rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op5_line_blocks(spark, sf):
    return html_text.extract(table(spark, sf, "pages"))


@query
def op6_sentence_spans(spark, sf):
    return sentence_spans.remove_repeated_spans(table(spark, sf, "documents"))


@query
def op7_spotsigs(spark, sf):
    return spotsigs.compare_edits(table(spark, sf, "documents"))


@query
def op8_secret_scan(spark, sf):
    found = secrets.secret_spans(table(spark, sf, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]

    def written(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def of(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("secrets", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id", *(of(k) for k in base), F.sha2(written(of_base), 256).alias("base_sha256"), written(F.col("secrets")).alias("spans")
    )


@query
def op9_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op10_suffix_dedup(spark, sf):
    found = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


@query
def op11_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))


@query
def op12_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"))


@query
def op13_spelling(spark, sf):
    return spelling.variants(table(spark, sf, "documents"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op1_pareto_mix": rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM sums
), weighed AS (
  SELECT *, CASE pos % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, source_size * 2 AS most,
         sum(source_size) OVER () * 1.5::DOUBLE AS all_words
  FROM ranked
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY most::DOUBLE / weight, pos) AS nr FROM weighed
), stops AS (
  SELECT *, most * (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0))
            + coalesce(sum(most) OVER earlier, 0) * weight <= all_words * weight AS stops
  FROM ordered WINDOW earlier AS (ORDER BY nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         CASE WHEN stops THEN most::DOUBLE
              ELSE (all_words - sum(CASE WHEN stops THEN most ELSE 0 END) OVER ())::DOUBLE * weight
                   / sum(CASE WHEN stops THEN 0 ELSE weight END) OVER () END AS target
  FROM stops
), shares AS (
  SELECT s.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS ratio,
         (('0x' || substr(md5('mix/' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '/' || size), 1, 12))::BIGINT::DOUBLE + 0.5)
           / 281474976710656 AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), fractions AS (
  SELECT *, floor(ratio) AS sure, ratio - floor(ratio) AS fraction FROM shares
), chances AS (
  SELECT *, 1 - pow(1 - fraction, 0.25 + 0.75 * least(1.0::DOUBLE, size / 200.0::DOUBLE)) AS p FROM fractions
), drawn AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) ELSE 1e300 END AS odds FROM chances
), run AS (
  SELECT *, odds / (1 + odds) AS rank, round(fraction * source_size) AS needed,
         sum(size) OVER (PARTITION BY source ORDER BY odds / (1 + odds), doc_id, size) AS upto
  FROM drawn
), reached AS (
  SELECT *, upto <= needed AS drawn,
         needed - coalesce(max(CASE WHEN upto <= needed THEN upto END) OVER (PARTITION BY source), 0) AS lacking
  FROM run
), placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY source, NOT drawn AND fraction > 0 AND abs(size - lacking) < lacking
    ORDER BY abs(size - lacking), rank, doc_id, size) AS place
  FROM reached
)
SELECT doc_id, size, source_size, target,
       CAST((sure + CASE WHEN fraction > 0 AND (drawn OR place = 1 AND abs(size - lacking) < lacking) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM placed""",
    "op11_collocations": r"""
WITH lowered AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), sizes AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang
), lengths AS (
  SELECT unnest([1, 2, 3, 4, 5]) AS d
), runs AS (
  SELECT lang, d, w, unnest(range(1, len(w) - d + 2)) AS i FROM worded, lengths WHERE len(w) >= d
), phrases AS (
  SELECT lang, d, w[i:i + d - 1] AS p, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
  SELECT * FROM phrases WHERE d > 1
), longer AS (
  SELECT lang, d - 1 AS d, unnest([p[1:d - 1], p[2:d]]) AS p, f FROM candidates WHERE d > 2
), inside AS (
  SELECT lang, p, max(f) AS f FROM longer GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inside i ON c.lang = i.lang AND c.p = i.p
  WHERE i.f IS NULL OR 100 * i.f < 100 * c.f
), cuts AS (
  SELECT *, unnest(range(1, d)) AS k FROM kept
), counted AS (
  SELECT c.lang, c.p, c.f AS a, c.k, x.f AS l, y.f AS r, s.n,
         (1000::HUGEINT * c.f * s.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN sizes s ON c.lang = s.lang
  JOIN phrases x ON x.lang = c.lang AND x.p = c.p[1:c.k]
  JOIN phrases y ON y.lang = c.lang AND y.p = c.p[c.k + 1:c.d]
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM counted
), ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
  FROM lowest WHERE place = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
    "op12_exact_dedup": r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) AS place FROM hashed
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, place = 1 AS kept, text_sha256
FROM placed WINDOW same AS (PARTITION BY text_sha256)""",
    "op13_spelling": r"""
WITH RECURSIVE steps AS (
  SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8
), lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), found AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM lowered
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS keyed, run, count(*) AS n FROM found WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(keyed)), '..'), lambda x: ('0x' || x)::BIGINT)),
           lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1]))) AS h
  FROM runs, crc
), spelt AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), less AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, w.word FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word FROM less l JOIN words w ON l.rest = w.word
), ranked AS (
  SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS place
  FROM pairs p JOIN words w ON p.near = w.word
), judged AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
         CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1
), chains AS (
  SELECT word, form AS at FROM judged WHERE form IS NOT NULL
  UNION ALL
  SELECT c.word, j.form FROM chains c JOIN judged j ON c.at = j.word WHERE j.form IS NOT NULL
), ends AS (
  SELECT c.word, c.at AS root FROM chains c JOIN judged j ON c.at = j.word WHERE j.form IS NULL
)
SELECT j.word, j.n, j.n_near, j.form, j.form_n, coalesce(e.root, j.word) AS root FROM judged j LEFT JOIN ends e ON j.word = e.word""",
}


def oracles() -> dict[str, str]:
    return dict(ORACLES)