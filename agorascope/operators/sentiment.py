"""Lexicon scorers (M1, M2, M3, M9). The lexicon is a table (token, valence) the caller supplies."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope import fixed
from agorascope.functions import text
from agorascope.functions.scores import polarity_label
from agorascope.operators import tokens
from agorascope.operators.phrases import PhraseTrie
from agorascope.operators.skew import fits_broadcast
from agorascope.session import ship


@dataclass(frozen=True)
class Rules:
    """Word classes of the compound score; the defaults are the common English ones of `fixed`. Degree words may be phrases."""

    strengtheners: Collection[str] = tuple(fixed.STRENGTHENERS)
    weakeners: Collection[str] = tuple(fixed.WEAKENERS)
    negators: Collection[str] = tuple(fixed.NEGATORS)
    contrast: str = "but"


#: Bytes of text whose words a task holds at once; batches of rows are cut to it.
BLOCK = 1 << 20


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(lower-case words, where each text begins and the last one ends, whether a word is in capitals).

    White-space words without outer punctuation; words of up to two characters stay as written.
    """
    flat, starts = tokens.pieces(texts)
    core = pc.ascii_trim(flat, characters=fixed.PUNCTUATION)
    words = pc.if_else(pc.less_equal(pc.utf8_length(core), 2), flat, core)
    lower, upper = pc.ascii_lower(words), pc.ascii_is_upper(words)
    other = pc.invert(pc.string_is_ascii(words))
    if pc.any(other).as_py():  # letters beyond ASCII may change their number
        own = words.filter(other).to_pylist()
        lower = pc.replace_with_mask(lower, other, pa.array([w.lower() for w in own], lower.type))
        upper = pc.replace_with_mask(upper, other, pa.array([w.upper() == w and w.lower() != w for w in own], pa.bool_()))
    return lower, starts, upper.to_numpy(zero_copy_only=False)


def _emphasis(texts: pa.Array) -> np.ndarray:
    cried, asked = (pc.fill_null(pc.count_substring(texts, mark), 0).to_numpy() for mark in "!?")
    question = np.where(asked > 3, fixed.QUESTION_MAX, np.where(asked > 1, asked * fixed.QUESTION_STEP, 0.0))
    return np.minimum(cried, 4) * fixed.EXCLAMATION_STEP + question


#: The most words of an idiom: one that ends at a word begins at most three words before it.
IDIOM_WORDS = 4
_NAMED = ("no", "or", "nor", "never", "so", "this", "without", "doubt", "least", "at", "very", "kind", "of")


def _valences(lexicon: DataFrame, key: str = "token", value: str = "valence") -> dict[str, float]:
    """The lexicon as a model of bounded size; larger ones are refused, since every task holds it."""
    ship(lexicon.sparkSession)
    lexicon = lexicon.select(F.lower(key).alias("word"), F.col(value).cast("double").alias("v"))
    lexicon = lexicon.filter("word IS NOT NULL AND v IS NOT NULL").groupBy("word").agg(F.min("v").alias("v"))
    if not fits_broadcast(lexicon):
        raise ValueError("the lexicon is too large to be held by every task")
    return {row.word: row.v for row in lexicon.collect()}


class Scorer:
    """The compound score's word rules for a batch of texts at once.

    Words are looked up once and become numbers; a rule about neighbours is an expression on the numbers shifted by one,
    two or three places, at the places of lexicon words only.
    """

    def __init__(self, valences: Mapping[str, float], rules: Rules, idioms: Mapping[str, float]):
        phrases = {tuple(p.split()): v for p, v in idioms.items()}
        steps = [(w, fixed.BOOST) for w in rules.strengtheners] + [(w, -fixed.BOOST) for w in rules.weakeners]
        degrees = {tuple(w.split()): step for w, step in steps}
        if any(len(p) > IDIOM_WORDS for p in phrases):
            raise ValueError(f"an idiom has at most {IDIOM_WORDS} words")
        words = {*valences, *rules.strengtheners, *rules.weakeners, *rules.negators, rules.contrast, *_NAMED}
        words.update(w for p in [*phrases, *degrees] for w in p)
        number = {w: i for i, w in enumerate(sorted(words))}
        self.words = pa.array(sorted(words))
        self.none = len(number)
        self.named = {w: number[w] for w in (*_NAMED, rules.contrast)}
        self.contrast = number[rules.contrast]
        self.valence = np.zeros(self.none + 1)
        self.scored, self.strong, self.weak, self.negating = (np.zeros(self.none + 1, bool) for _ in range(4))
        for w, v in valences.items():
            self.valence[number[w]], self.scored[number[w]] = v, True
        for mark, own in ((self.strong, rules.strengtheners), (self.weak, rules.weakeners), (self.negating, rules.negators)):
            mark[[number[w] for w in own]] = True
        self.negating |= np.array(["n't" in w for w in sorted(words)] + [False])
        numbered = lambda table: {tuple(number[w] for w in p): v for p, v in table.items() if len(p) > 1}
        self.idioms, self.degrees = PhraseTrie(numbered(phrases)), PhraseTrie(numbered(degrees))

    def sums(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The sum of the values of each text's words, and whether it has any word."""
        flat, starts, capitals = _words(texts)
        lengths = np.diff(starts)
        ids = pc.fill_null(pc.index_in(flat, value_set=self.words), self.none).to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(lengths)), lengths)
        shouted = np.bincount(row, weights=capitals, minlength=len(lengths))
        loud = capitals & ((shouted > 0) & (shouted < lengths))[row]
        turn = np.full(len(lengths), -1)
        turns = np.flatnonzero(ids == self.contrast)[::-1]
        turn[row[turns]] = turns  # the first one of each text is set last
        hits = np.flatnonzero(self.scored[ids])
        negating = self.negating[ids] | pc.match_substring(flat, "n't").to_numpy(zero_copy_only=False)
        value = self._values(ids, hits, starts[row[hits]], starts[row[hits] + 1], loud, negating, starts[row + 1])
        after = turn[row[hits]]
        weight = np.where((after < 0) | (hits == after), 1.0, np.where(hits < after, fixed.CONTRAST_BEFORE, fixed.CONTRAST_AFTER))
        return np.bincount(row[hits], weights=weight * value, minlength=len(lengths)), lengths > 0

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each text's sum with its emphasis, bounded to [-1, 1], and whether it has any word."""
        s, worded = self.sums(texts)
        s = s + np.sign(s) * _emphasis(texts)
        return np.clip(s / np.sqrt(s * s + fixed.NORMALISER), -1.0, 1.0), worded

    def _values(
        self, ids: np.ndarray, hits: np.ndarray, first: np.ndarray, end: np.ndarray, loud: np.ndarray, negating: np.ndarray, ends: np.ndarray
    ) -> np.ndarray:
        """What the word at each hit adds; `first` and `end` bound the hit's text, `ends` is the end of each word's text."""
        near = lambda k: np.clip(hits - k, 0, max(0, len(ids) - 1))
        there = {k: (hits - k >= first) & (hits - k < end) for k in (-1, 1, 2, 3)}
        at = {k: np.where(there[k], ids[near(k)], self.none) for k in there}
        word, after, p1, p2, p3 = ids[hits], at[-1], at[1], at[2], at[3]
        is_ = lambda p, *names: np.isin(p, [self.named[n] for n in names])

        v = self.valence[word]
        refused = is_(p1, "no") | is_(p2, "no") | (is_(p3, "no") & is_(p1, "or", "nor"))
        v = np.where(refused, v * fixed.NEGATION_FACTOR, np.where(is_(word, "no") & self.scored[after], 0.0, v))
        v = np.where(loud[hits], v + np.where(v > 0, fixed.CAPS_BOOST, -fixed.CAPS_BOOST), v)
        no = np.zeros(len(hits), bool)
        emphasised = (no, is_(p2, "never") & is_(p1, "so", "this"), is_(p3, "never") & (is_(p2, "so", "this") | is_(p1, "so", "this")))
        assured = (no, is_(p2, "without") & is_(p1, "doubt"), is_(p3, "without") & (is_(p2, "doubt") | is_(p1, "doubt")))
        for k, p in enumerate((p1, p2, p3)):
            counts = there[k + 1] & ~self.scored[p]
            step = np.where(self.strong[p], fixed.BOOST, -fixed.BOOST)
            step = np.where(v < 0, -step, step)
            step = np.where(loud[near(k + 1)], step + np.where(v > 0, fixed.CAPS_BOOST, -fixed.CAPS_BOOST), step)
            v = np.where(counts & (self.strong[p] | self.weak[p]), v + step * fixed.BOOST_DECAY[k], v)
            denied = negating[near(k + 1)] & ~assured[k]
            factor = np.where(emphasised[k], fixed.NEVER_FACTOR, np.where(denied, fixed.NEGATION_FACTOR, 1.0))
            v = np.where(counts, v * factor, v)
        v = np.where(counts, self._idiomatic(v, ids, hits, ends), v)
        if not self.scored[self.named["least"]]:
            v = np.where(is_(p1, "least") & ~is_(p2, "at", "very"), v * fixed.NEGATION_FACTOR, v)
        degree = self.strong[word] | self.weak[word]
        return np.where(degree | (is_(word, "kind") & is_(after, "of")), 0.0, v)

    def _idiomatic(self, v: np.ndarray, ids: np.ndarray, hits: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Values after idioms and degree phrases, for words that have three words before them."""
        room = ends - np.arange(len(ids))
        if self.idioms.longest:
            found = self.idioms.found(ids, room)
            begins = lambda back, length: found[length][np.maximum(hits - back, 0)] if length < len(found) else np.nan
            own = np.full(len(v), np.nan)
            for ends_before in (0, 1, 2):
                for length in range(2, IDIOM_WORDS + 1 - ends_before):
                    own = np.where(np.isnan(own), begins(ends_before + length - 1, length), own)
            for length in range(2, IDIOM_WORDS + 1):
                here = begins(0, length)
                own = np.where(np.isnan(here), own, here)
            v = np.where(np.isnan(own), v, own)
        if self.degrees.longest:
            found = self.degrees.found(ids, room)
            for back, length in ((3, 3), (3, 2), (2, 2)):
                if length < len(found):
                    step = found[length][np.maximum(hits - back, 0)]
                    v = np.where(np.isnan(step), v, v + step)
        return v


def _speller(emoji: DataFrame) -> Callable[[pa.Array], pa.Array]:
    """Texts with their emoji written out, from a table (emoji, words) of single code points.

    Words follow a space unless the text begins or has one there; only texts that hold an emoji are touched. An emoji of
    several code points is read code point by code point.
    """
    ship(emoji.sparkSession)
    kept = emoji.filter("char_length(emoji) = 1 AND words IS NOT NULL").groupBy("emoji").agg(F.min("words").alias("words"))
    if not fits_broadcast(kept):
        raise ValueError("the emoji table is too large to be held by every task")
    words = {r.emoji: r.words for r in kept.collect()}
    if not words:
        return lambda texts: texts
    one = "[" + "".join(f"\\x{{{ord(e):x}}}" for e in sorted(words)) + "]"
    any_of = re.compile("[" + "".join(map(re.escape, sorted(words))) + "]")

    def write(m: re.Match[str]) -> str:
        at = m.start()
        return (" " if at and m.string[at - 1] != " " else "") + words[m[0]]

    def spelled(texts: pa.Array) -> pa.Array:
        held = pc.fill_null(pc.match_substring_regex(texts, one), False)
        if not pc.any(held).as_py():
            return texts
        changed = pa.array([any_of.sub(write, t) for t in texts.filter(held).to_pylist()], texts.type)
        return pc.replace_with_mask(texts, held, changed)

    return spelled


def described(emoji: DataFrame) -> Callable[[Column], Column]:
    """M1: a column function that writes out emoji (see `_speller`)."""
    spelled = _speller(emoji)

    @F.arrow_udf("string")
    def write(texts: pa.Array) -> pa.Array:
        return spelled(texts)

    return write


def compound(
    lexicon: DataFrame, rules: Rules = Rules(), idioms: DataFrame | None = None, emoji: DataFrame | None = None
) -> Callable[[Column], Column]:
    """M1: a column function from text to its score in [-1, 1]; null for null or blank text.

    A score depends on its row's text alone: no shuffle, no id, and the same in batch and stream. Emoticons are tokens of
    the lexicon. `emoji` (emoji, words) are written out first. `idioms` (phrase, valence) of two to four words and degree
    phrases among the rules' word lists act where the published scorer looks for them: on a lexicon word with three words
    before it, the first of which is not in the lexicon. The word takes the value of an idiom that begins at it (the longest),
    else of one that ends at it, one or two words before it (nearest, then shortest), if that begins at most three words before.
    """
    rules = Rules(*(tuple(w.lower() for w in own) for own in (rules.strengtheners, rules.weakeners, rules.negators)), rules.contrast)
    scorer = Scorer(_valences(lexicon), rules, {} if idioms is None else _valences(idioms, "phrase"))
    spelled = (lambda texts: texts) if emoji is None else _speller(emoji)

    @F.arrow_udf("double")
    def bounded(texts: pa.Array) -> pa.Array:
        found = [scorer.scores(spelled(block)) for block in tokens.blocks(texts, BLOCK)]
        values, worded = (np.concatenate(parts) for parts in zip(*found, strict=True))
        return pa.array(values, mask=~worded)

    return lambda c: F.round(bounded(c), 4)


def polarity(lexicon: DataFrame) -> Callable[[Column], Column]:
    """M2: a column function to the mean valence of the text's words found in the lexicon, 0 when none is.

    Words are those of `text.tokens`.
    """
    valences = {w: v for w, v in _valences(lexicon).items() if len(w) > 1}  # a token has two characters at least
    known, values = pa.array(list(valences), pa.string()), np.array(list(valences.values()))

    def found(words: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy().astype(np.int64)

    def means(texts: pa.Array) -> np.ndarray:
        words, starts = tokens.runs(texts)
        ids = found(words)
        hits = np.flatnonzero(ids >= 0)
        row = np.searchsorted(starts, hits, side="right") - 1
        n = np.bincount(row, minlength=len(texts))
        total = np.bincount(row, weights=values[ids[hits]], minlength=len(texts))  # added up in order: a threshold may lie on the mean
        return total / np.maximum(n, 1)

    @F.arrow_udf("double")
    def mean(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([means(block) for block in tokens.blocks(texts, BLOCK)]))

    return lambda c: mean(F.lower(F.coalesce(c, F.lit(""))))


def compound_scores(
    docs: DataFrame, lexicon: DataFrame, id_col: str = "id", text_col: str = "text", rules: Rules = Rules(),
    idioms: DataFrame | None = None, emoji: DataFrame | None = None,
) -> DataFrame:
    """M1: (id, compound) for each row with text; null for blank text. Ids may repeat or be null."""
    kept = docs.filter(F.col(text_col).isNotNull())
    return kept.select(id_col, compound(lexicon, rules, idioms, emoji)(F.col(text_col)).alias("compound"))


def mean_polarity(
    docs: DataFrame, lexicon: DataFrame, id_col: str = "id", text_col: str = "text"
) -> DataFrame:
    """M2: (id, polarity) for each row. Ids may repeat or be null."""
    return docs.select(id_col, polarity(lexicon)(F.col(text_col)).alias("polarity"))


def score_table(
    records: DataFrame,
    lexicon: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    rules: Rules = Rules(),
    labels: Sequence[str] = fixed.LONG_LABELS,
    scored_at: Column | None = None,
) -> DataFrame:
    """M3: records with text plus sentiment_compound, sentiment_label and scored_at."""
    kept = records.filter(text.has_text(F.col(text_col)))
    return (
        kept.withColumn("sentiment_compound", compound(lexicon, rules)(F.col(text_col)))
        .withColumn("sentiment_label", polarity_label(F.col("sentiment_compound"), labels))
        .withColumn("scored_at", F.current_timestamp() if scored_at is None else scored_at)
    )


def weak_labels(
    docs: DataFrame,
    lexicon: DataFrame,
    polarity_lexicon: DataFrame | None = None,
    id_col: str = "id",
    text_col: str = "text",
    rules: Rules = Rules(),
) -> DataFrame:
    """M9: (id, compound, compound_label, polarity, polarity_label); missing text scores 0."""
    polarity_lexicon = lexicon if polarity_lexicon is None else polarity_lexicon
    filled = F.coalesce(F.col(text_col), F.lit(""))
    both = docs.select(
        id_col, compound(lexicon, rules)(filled).alias("compound"), polarity(polarity_lexicon)(filled).alias("polarity")
    )
    compound_value = F.coalesce("compound", F.lit(0.0))
    return both.select(
        id_col,
        compound_value.alias("compound"),
        polarity_label(compound_value).alias("compound_label"),
        "polarity",
        polarity_label(F.col("polarity"), inclusive=False).alias("polarity_label"),
    )
