"""Words of articles."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.catalog.base import Catalog, FINE_GRID, gridded, gridded_sql
from barloom.operators import keywords, segments, terms
from barloom.operators.sets import union_all
from barloom.plans import views
from barloom.session import work_folder

catalog = Catalog()
query = catalog.query

_TERMS = r"""terms AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM documents)"""


@query("text_tokens", f"WITH {_TERMS} SELECT doc_id, term, count(*) AS term_count FROM terms GROUP BY doc_id, term")
def text_tokens(spark, d):
    words = terms.tokens(views.table(spark, d, "documents"))
    return words.groupBy("doc_id", "term").agg(F.count("*").alias("term_count"))


@query(
    "text_term_freq",
    f"""WITH {_TERMS} SELECT term, count(*) AS term_count FROM terms GROUP BY term
    ORDER BY term_count DESC, term LIMIT 200""",
)
def text_term_freq(spark, d):
    return terms.term_freq(views.table(spark, d, "documents"), 200)


@query(
    "text_top_terms",
    f"""WITH {_TERMS} SELECT term, count(*) AS term_count FROM terms GROUP BY term
    ORDER BY term_count DESC, term LIMIT 30""",
)
def text_top_terms(spark, d):
    return terms.top_terms(views.table(spark, d, "documents"), 30, capacity=500)


@query(
    "text_term_assoc",
    f"""WITH {_TERMS}, dt AS (SELECT DISTINCT doc_id, term FROM terms),
    has AS (SELECT doc_id FROM dt WHERE term = 'the'),
    t AS (SELECT term, count(*) AS doc_count, count(h.doc_id) AS both_count
      FROM dt LEFT JOIN has h ON h.doc_id = dt.doc_id GROUP BY term),
    n AS (SELECT CAST((SELECT count(*) FROM documents) AS DOUBLE) AS n, CAST((SELECT count(*) FROM has) AS DOUBLE) AS k),
    p AS (SELECT term, doc_count, both_count, (n * both_count - k * doc_count)
      / nullif(sqrt(k * (n - k)) * sqrt(doc_count * (n - doc_count)), 0) AS phi
      FROM t, n WHERE both_count >= 5 AND term <> 'the')
    SELECT term, doc_count, both_count, {gridded_sql('phi', grid=FINE_GRID)} FROM p""",
)
def text_term_assoc(spark, d):
    found = terms.term_assoc(views.table(spark, d, "documents"), "the", min_support=5)
    return found.select("term", "doc_count", "both_count", *gridded("phi", grid=FINE_GRID))


@query(
    "text_keyword_range",
    """SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn
    FROM documents WHERE contains(text, 'the')) q WHERE rn BETWEEN 41 AND 100""",
)
def text_keyword_range(spark, d):
    index = work_folder(spark, "keywords")
    keywords.build(views.table(spark, d, "documents"), index)
    return keywords.pages(spark, index, "the", 3, 5, page_size=20)


_SOUGHT = (("ti", 2, 3), ("tion", 1, 4), ("ß", 1, 2), ("entlich", 1, 2))


@query(
    "text_keyword_pages",
    " UNION ALL ".join(
        f"""SELECT '{word}' AS word, doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn
    FROM documents WHERE contains(text, '{word}')) q WHERE rn BETWEEN {20 * first - 19} AND {20 * last}"""
        for word, first, last in _SOUGHT
    ),
)
def text_keyword_pages(spark, d):
    index = work_folder(spark, "keywords")
    keywords.build(views.table(spark, d, "documents"), index, part_rows=300)
    found = [keywords.pages(spark, index, *sought, page_size=20).withColumn("word", F.lit(sought[0])) for sought in _SOUGHT]
    return union_all(found)


@query(
    "text_merge_feeds",
    """SELECT 'documents' AS site, doc_id, text, source FROM documents
    UNION ALL SELECT 'pages', page_id, html, NULL FROM pages
    UNION ALL SELECT 'conversations', conv_id, text, role FROM conversations""",
)
def text_merge_feeds(spark, d):
    documents = views.table(spark, d, "documents").select("doc_id", "text", "source")
    pages = views.table(spark, d, "pages").select(
        F.col("page_id").alias("doc_id"), F.col("html").alias("text")
    )
    talks = views.table(spark, d, "conversations").select(
        F.col("conv_id").alias("doc_id"), "text", F.col("role").alias("source")
    )
    return terms.merge_feeds({"documents": documents, "pages": pages, "conversations": talks})


# ------------------------------------------------------------- Han words
_LETTERS, _SIGNS = views.LETTER_SIGNS
_RUNS = f"""articles AS (SELECT doc_id, translate(lower(replace(text, ' ', '')), '{_LETTERS}', '{_SIGNS}') AS text FROM documents),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\p{{Han}}+')) AS run FROM articles)"""
_COUNTS = f"""places AS (SELECT '^' || run || '^' AS r, unnest(generate_series(1, length(run) + 2)) AS i FROM runs),
strings AS (SELECT substr(r, i, n) AS word, n FROM places, generate_series(1, {segments.MOST_SIGNS + 1}) t(n)
  WHERE i + n - 1 <= length(r)),
every AS (SELECT word, n, count(*) AS c FROM strings GROUP BY word, n),
inside AS (SELECT * FROM every WHERE n <= {segments.MOST_SIGNS} AND NOT contains(word, '^')),
parts AS (SELECT w.word, w.c, ln(w.c * CAST((SELECT sum(c) FROM inside WHERE n = 1) AS DOUBLE) / (CAST(a.c AS DOUBLE) * b.c)) AS mi
  FROM (SELECT *, unnest(generate_series(1, n - 1)) AS cut FROM inside WHERE n > 1 AND c >= {segments.MIN_COUNT}) w
  JOIN inside a ON a.word = left(w.word, w.cut) JOIN inside b ON b.word = right(w.word, w.n - w.cut)),
cohesive AS (SELECT word, min(c) AS c, min(mi) AS cohesion FROM parts GROUP BY word HAVING min(mi) >= {segments.MIN_COHESION}),
behind AS (SELECT left(word, n - 1) AS word, ln(sum(c)) - sum(c * ln(c)) / sum(c) AS e FROM every WHERE n > 1 GROUP BY left(word, n - 1)),
ahead AS (SELECT right(word, n - 1) AS word, ln(sum(c)) - sum(c * ln(c)) / sum(c) AS e FROM every WHERE n > 1 GROUP BY right(word, n - 1)),
known AS (SELECT word, c AS count, cohesion, least(behind.e, ahead.e) AS entropy
  FROM cohesive JOIN behind USING (word) JOIN ahead USING (word) WHERE least(behind.e, ahead.e) >= {segments.MIN_ENTROPY}
  UNION ALL SELECT word, c, NULL, NULL FROM inside WHERE n = 1),
dictionary AS (SELECT *, CAST(round(log2(CAST((SELECT sum(count) FROM known) AS DOUBLE) / count) * {segments.COST_STEPS}) AS BIGINT) AS cost FROM known)"""


def _learned(spark, d):
    """The dictionary of the articles, stored, as cutting reads it more than once."""
    path = work_folder(spark, "dictionary")
    segments.learn_words(views.han_articles(spark, d)).write.parquet(path)
    return spark.read.parquet(path)


@query("text_words", f"WITH {_RUNS}, {_COUNTS} SELECT word, count, {gridded_sql('cohesion', 'entropy')}, cost FROM dictionary")
def text_words(spark, d):
    return _learned(spark, d).select("word", "count", *gridded("cohesion", "entropy"), "cost")


# from the end of a run to its start: the least cost of the rest from here and from the next three places, and
# the signs of the first word; then from the start to the end
_STEPS = ", ".join(f"coalesce(d{n}.cost, 1099511627776) + b{n}" for n in range(1, segments.MOST_SIGNS + 1))
_CHOSEN = " ".join(f"WHEN coalesce(d{n}.cost, 1099511627776) + b{n} = least({_STEPS}) THEN {n}" for n in range(segments.MOST_SIGNS, 0, -1))
_JOINS = " ".join(f"LEFT JOIN dictionary d{n} ON d{n}.word = substr(run, i - 1, {n}) AND i + {n} <= size + 2" for n in range(1, segments.MOST_SIGNS + 1))
_WAYS = f"""WITH RECURSIVE {_RUNS}, {_COUNTS},
texts AS (SELECT DISTINCT run, length(run) AS size FROM runs),
back AS (SELECT run, size, size + 1 AS i, CAST(0 AS BIGINT) AS b1, 1099511627776 AS b2, 1099511627776 AS b3,
    1099511627776 AS b4, 0 AS n FROM texts
  UNION ALL SELECT run, size, i - 1, least({_STEPS}), b1, b2, b3, CASE {_CHOSEN} END FROM back {_JOINS} WHERE i > 1),
ahead_of AS (SELECT run, list(n ORDER BY i) AS n FROM back WHERE n > 0 GROUP BY run),
cut AS (SELECT run, 1 AS i, n FROM ahead_of UNION ALL SELECT run, i + n[i], n FROM cut WHERE i + n[i] <= length(run))"""


@query(
    "text_segments",
    f"""{_WAYS}, words AS (SELECT run, substr(run, i, n[i]) AS term FROM cut)
    SELECT doc_id, term, count(*) AS term_count FROM runs JOIN words USING (run) GROUP BY doc_id, term""",
)
def text_segments(spark, d):
    words = segments.segments(views.han_articles(spark, d), _learned(spark, d))
    return words.where(F.col("term").rlike(r"^\p{IsHan}")).groupBy("doc_id", "term").agg(F.count("*").alias("term_count"))
