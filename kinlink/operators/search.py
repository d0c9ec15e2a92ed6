"""Full-text retrieval by BM25 as one set-based join."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.operators.relational import top_k

# Letters with accents that are stripped before words are taken.
ACCENTS = "àáâãäåèéêëìíîïòóôõöùúûüýÿñç", "aaaaaaeeeeiiiiooooouuuuyync"


@dataclass(frozen=True)
class BM25:
    """Okapi's parameters. log_base is open, as absolute thresholds on scores depend on it."""

    k1: float = 1.2
    b: float = 0.75
    log_base: float = 2.718281828459045


def words(c: Column) -> Column:
    """Runs of a to z after lower case and accents stripped; digits and signs only separate."""
    plain = F.translate(F.lower(c), *ACCENTS)
    return F.filter(F.split(F.regexp_replace(plain, "[^a-z]+", " "), " "), lambda w: w != "")


def postings(docs: DataFrame, doc_id: str, fields: list[str]) -> DataFrame:
    """(doc, term, tf, length): how often each word occurs over the fields of each document."""
    text = reduce(lambda a, b: F.concat(a, F.lit(" "), b), [F.coalesce(F.col(f), F.lit("")) for f in fields])
    d = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc"), words(text).alias("w"))
    return d.select("doc", F.size("w").alias("length"), F.explode("w").alias("term")).groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("length").alias("length"))


def bm25_top_k(queries: DataFrame, query_id: str, text: str, docs: DataFrame, doc_id: str, fields: list[str], block: tuple[str, str], k: int, p: BM25 = BM25(), cut=None) -> DataFrame:
    """(query, doc, score): the k best documents of each query in its block, by score, then doc.

    Statistics (number of documents, their mean length, documents per word) are of all documents;
    blocks (compared in lower case) only limit the join, so words meet within a block and the join is on
    block and word. Every distinct word of a query counts once; documents without any of them and
    queries without words have no row. Only postings of words that some query of their block has are scored. cut, if
    given, keeps the postings, which are read for three statistics and the join.
    """
    q_block, d_block = block
    post = postings(docs, doc_id, fields)
    post = cut(post) if cut else post
    lengths = post.groupBy("doc").agg(F.first("length").alias("length"))
    stats = docs.where(F.col(doc_id).isNotNull()).agg(F.count(F.lit(1)).alias("n_docs")).crossJoin(lengths.agg(F.sum("length").alias("total")))
    df = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    place = docs.select(F.col(doc_id).alias("doc"), F.lower(d_block).alias("block"))
    q = queries.select(F.col(query_id).alias("query"), F.lower(q_block).alias("block"), F.explode(F.array_distinct(words(F.col(text)))).alias("term"))
    asked = post.join(place, "doc").join(q.select("block", "term").distinct(), ["block", "term"], "left_semi")
    scored = asked.join(df, "term").crossJoin(F.broadcast(stats))  # stats is one row
    idf = F.log1p((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)) / F.log(F.lit(p.log_base))
    norm = p.k1 * (1 - p.b + p.b * F.col("length") / (F.col("total") / F.col("n_docs")))
    part = idf * F.col("tf") * (p.k1 + 1) / (F.col("tf") + norm)
    scored = scored.select("block", "term", "doc", part.alias("part"))
    hits = q.join(scored, ["block", "term"]).groupBy("query", "doc").agg(F.sum("part").alias("score"))
    return top_k(hits, ["query"], [F.desc("score"), F.asc("doc")], k)
