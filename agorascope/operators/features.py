"""TF-IDF features (M4)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agorascope.operators import tokens
from agorascope.operators.lineage import cut
from agorascope.session import ship


#: Bytes of text whose terms a task counts at once.
BLOCK = 4 << 20


def _kept(words: pa.Array, stop: pa.Array) -> np.ndarray:
    """Which words count: two characters or more, and no stop word."""
    dropped = pc.or_(pc.less(pc.utf8_length(words), 2), pc.is_in(words, value_set=stop))
    return ~dropped.to_numpy(zero_copy_only=False)


def _block_totals(texts: pa.Array, stop: pa.Array, ngrams: int) -> pa.RecordBatch:
    """(term, df, cf) within these lower-case texts. A pair is a number made of its words' numbers until it is counted."""
    words, starts = tokens.runs(texts)
    coded = words.dictionary_encode()
    names, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    kept = _kept(names, stop)[ids]
    row, ids = np.repeat(np.arange(len(texts)), np.diff(starts))[kept], ids[kept]
    size, n = max(1, len(names)), max(1, len(texts))
    cells = ids * n + row
    if ngrams == 2:
        near = row[1:] == row[:-1]
        cells = np.concatenate([cells, ((ids[:-1] + 1) * size + ids[1:])[near] * n + row[1:][near]])
    cells, counts = np.unique(cells, return_counts=True)
    codes = cells // n
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    codes, df = codes[first], np.diff(first, append=len(cells))
    cf = np.add.reduceat(counts, first) if len(first) else counts
    single = int(np.searchsorted(codes, size))
    heads, tails = names.take(pa.array(codes[single:] // size - 1)), names.take(pa.array(codes[single:] % size))
    terms = pa.concat_arrays([names.take(pa.array(codes[:single])), pc.binary_join_element_wise(heads, tails, " ")])
    return pa.RecordBatch.from_arrays([terms, pa.array(df, pa.int64()), pa.array(cf, pa.int64())], ["term", "df", "cf"])


def _lower(text_col: str) -> Column:
    return F.lower(F.coalesce(F.col(text_col), F.lit("")))


def term_totals(docs: DataFrame, text_col: str, stop_words: Sequence[str] = (), ngrams: int = 2) -> DataFrame:
    """(term, df, cf): rows that hold a word or, for `ngrams` 2, a pair of neighbours, and its occurrences; stop words are left out first.

    A block of texts is counted in its task, so a term is shuffled once a block that holds it.
    """
    ship(docs.sparkSession)
    stop = pa.array(list(stop_words), pa.string())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tokens.blocks(batch.column(0), BLOCK):
                yield _block_totals(block, stop, ngrams)

    found = docs.select(_lower(text_col).alias("text")).mapInArrow(counted, "term string, df long, cf long")
    return found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def vocabulary(totals: DataFrame, docs: int, max_features: int, min_df: int = 1) -> DataFrame:
    """(term_id, term, df, cf, idf): the `max_features` terms of largest corpus count, ties by term.

    A histogram of counts by powers of two first drops terms that cannot be among them, so the
    final sort sees little more than `max_features` rows.
    """
    totals = cut(totals.filter(F.col("df") >= min_df), "vocabulary")
    size = F.floor(F.log2("cf"))
    rows = totals.groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect()  # 64 at most
    kept, floor = 0, 0
    for row in sorted(rows, key=lambda r: -r["size"]):
        kept, floor = kept + row["n"], row["size"]
        if kept >= max_features:
            break
    top = totals.filter(size >= floor).orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    number = F.row_number().over(W.orderBy("term")) - 1  # max_features rows
    idf = F.log((1.0 + F.lit(docs)) / (1.0 + F.col("df"))) + 1.0
    return cut(top.select(number.alias("term_id"), "term", "df", "cf", idf.alias("idf")), "vocabulary")


def weigher(vocab: DataFrame, stop_words: Sequence[str] = ()) -> Callable[[Column], Column]:
    """A column function from a row's lower-case text to its features: an array of (term_id, term, weight) with unit L2 norm.

    The vocabulary is a model of at most max_features terms, which every task holds: a row's weights need its own terms
    only, so nothing is shuffled and rows of one id stay apart. Pairs are looked up by the numbers of their words.
    """
    ship(vocab.sparkSession)
    rows = vocab.select("term", "idf").orderBy("term_id").toArrow()
    names, idf = rows["term"].combine_chunks().cast(pa.string()), rows["idf"].to_numpy()
    stop, size = pa.array(list(stop_words), pa.string()), max(1, len(names))
    split = [t.split(" ") for t in names.to_pylist()]
    number = {w: i for i, w in enumerate(sorted({w for t in split for w in t}))}
    known, base = pa.array(list(number), pa.string()), len(number) + 1
    single = np.full(base, -1)
    single[[number[t[0]] for t in split if len(t) == 1]] = [i for i, t in enumerate(split) if len(t) == 1]
    double = sorted((number[t[0]] * base + number[t[1]], i) for i, t in enumerate(split) if len(t) == 2)
    codes, pair = np.array([*(c for c, _ in double), np.iinfo(np.int64).max]), np.array([*(i for _, i in double), -1])

    def weighed(texts: pa.Array) -> pa.Array:
        words, starts = tokens.runs(texts)
        kept = _kept(words, stop)
        ids = pc.fill_null(pc.index_in(words, value_set=known), base - 1).to_numpy().astype(np.int64)[kept]
        row = np.repeat(np.arange(len(texts)), np.diff(starts))[kept]
        wanted = np.where(row[1:] == row[:-1], ids[:-1] * base + ids[1:], -1)
        at = np.searchsorted(codes, wanted)
        ids = np.concatenate([single[ids], np.where(codes[at] == wanted, pair[at], -1)])
        row = np.concatenate([row, row[1:]])
        cells, n = np.unique((row * size + ids)[ids >= 0], return_counts=True)
        row, ids = cells // size, cells % size
        weight = n * idf[ids] if len(ids) else np.zeros(0)
        norm = np.sqrt(np.bincount(row, weights=weight * weight, minlength=len(texts)))
        out = pa.StructArray.from_arrays(
            [pa.array(ids.astype(np.int32)), names.take(pa.array(ids)), pa.array(weight / norm[row])], ["term_id", "term", "weight"]
        )
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)), out)

    @F.arrow_udf("array<struct<term_id:int,term:string,weight:double>>")
    def weigh(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([weighed(block) for block in tokens.blocks(texts, BLOCK)])

    return weigh


def tfidf(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    stop_words: Sequence[str] = (),
    max_features: int = 20_000,
    min_df: int = 2,
    ngrams: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """M4: (vectors, vocabulary): `id_col` and features of each row, empty without a term of the vocabulary."""
    vocab = vocabulary(term_totals(docs, text_col, stop_words, ngrams), docs.count(), max_features, min_df)
    return docs.select(id_col, weigher(vocab, stop_words)(_lower(text_col)).alias("features")), vocab


def top_terms(features: DataFrame, id_col: str, k: int = 5) -> DataFrame:
    """K6: the `k` heaviest terms of each document, ties by term, taken inside its row."""
    ordered = F.sort_array(
        F.transform(
            "features",
            lambda x: F.struct((-F.round(x["weight"], 9)).alias("minus"), x["term"].alias("term")),
        )
    )
    listed = features.select(id_col, F.slice(ordered, 1, k).alias("_best"))
    best = listed.select(id_col, F.posexplode_outer("_best").alias("_i", "_x"))
    return best.filter(F.col("_x").isNotNull()).select(
        id_col, (F.col("_i") + 1).alias("rank"), "_x.term", (-F.col("_x.minus")).alias("weight")
    )
