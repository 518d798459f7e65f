"""Noun chunks, noun-verb-noun relations and the knowledge graph.

Everything up to the counts works on the (word, tag) array inside the row, so
neighbouring tokens never have to be brought together by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuro.operators.tagging import tagged_sentences
from murmuro.runtime import n_rows, top, unnest

ALPHABETIC = r"^\p{L}+$"


def from_token_rows(rows: DataFrame, key: str = "comment_id") -> DataFrame:
    """Token rows (key, pos, token, tag) gathered to one tagged array per comment."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", F.col("token").alias("word"), "tag")))
    shaped = F.transform(ordered, lambda x: F.struct(x["word"].alias("word"), x["tag"].alias("tag")))
    return rows.groupBy(key).agg(shaped.alias("tagged"))


def noun_chunks(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, chunk_no, chunk): maximal runs of at least two nouns.

    Nouns are written one after the other and every other token as a line break, so each
    line is one maximal run.
    """
    pieces = F.transform(
        "tagged", lambda x: F.when(x["tag"].startswith("NN"), F.concat(x["word"], F.lit(" "))).otherwise("\n")
    )
    runs = F.transform(F.split(F.array_join(pieces, ""), "\n"), lambda r: F.trim(r))
    return unnest(tagged, F.filter(runs, lambda r: r.contains(" ")), "chunk", key, pos="chunk_no")


def _triple_array(tagged: Column) -> Column:
    kept = F.filter(tagged, lambda x: x["tag"] != "DT")
    n = F.greatest(F.size(kept) - 2, F.lit(0))
    windows = F.zip_with(
        F.zip_with(F.slice(kept, 1, n), F.slice(kept, 2, n), lambda a, b: F.struct(a.alias("s"), b.alias("v"))),
        F.slice(kept, 3, n),
        lambda p, o: F.struct(p["s"].alias("s"), p["v"].alias("v"), o.alias("o")),
    )
    return F.filter(
        windows,
        lambda x: x["s"]["tag"].startswith("NN") & x["v"]["tag"].startswith("VB") & x["o"]["tag"].startswith("NN"),
    )


def relation_triples(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, triple_no, subject, verb, object) for noun, verb, noun in a row, determiners skipped."""
    return unnest(tagged, _triple_array(F.col("tagged")), "x", key, pos="triple_no").select(
        key,
        "triple_no",
        F.col("x.s.word").alias("subject"),
        F.col("x.v.word").alias("verb"),
        F.col("x.o.word").alias("object"),
    )


def relation_strings(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, triple_no, relation) as `verb(subject, object)`."""
    text = F.format_string("%s(%s, %s)", "verb", "subject", "object")
    return relation_triples(tagged, key).select(key, "triple_no", text.alias("relation"))


def distinct_relations(tagged: DataFrame, key: str = "doc_id", limit: int | None = None) -> DataFrame:
    """Each relation once, in order of first appearance; `limit` keeps to the first comments."""
    if limit:
        tagged = top(tagged, limit, F.asc(key))
    firsts = relation_strings(tagged, key).groupBy("relation").agg(F.min(F.struct(key, "triple_no")).alias("first"))
    return firsts.orderBy("first").select("relation", F.col(f"first.{key}").alias(key), "first.triple_no")


def graph_edges(triples: DataFrame, max_edges: int = 30) -> DataFrame:
    """The most frequent lower-cased triples whose two ends are words."""
    clean = triples.where(F.col("subject").rlike(ALPHABETIC) & F.col("object").rlike(ALPHABETIC))
    counted = clean.groupBy(*[F.lower(c).alias(c) for c in ("subject", "verb", "object")]).agg(
        n_rows()
    )
    return top(counted, max_edges, F.desc("count"), F.asc("subject"), F.asc("verb"), F.asc("object"))


def graph_dot(edges: DataFrame) -> DataFrame:
    """One row holding the edge list (at most `max_edges` rows) as Graphviz text."""
    line = F.format_string('  "%s" -> "%s" [label="%s"];', "subject", "object", "verb")
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("c"), "subject", "verb", "object", line.alias("line"))))
    body = F.transform(ordered, lambda x: x["line"])
    head = F.array(F.lit("digraph KG {"), F.lit("  rankdir=LR; node [shape=box, style=rounded];"))
    return edges.agg(F.array_join(F.concat(head, body, F.array(F.lit("}"))), "\n").alias("dot"))


def tagged_comments(df: DataFrame, key: str = "doc_id") -> DataFrame:
    return tagged_sentences(df, key)
