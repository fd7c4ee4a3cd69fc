"""URL filters: rules first, then naive Bayes over segmented names.

- Hosts and paths are cut and rules are matched in DataFrame operations. The longest rule that fits decides.
- Segmentation: a unigram model of words cuts each run of letters of a name into its likeliest words (Viterbi; a run of
  unknown letters costs more with each letter). Its dictionary holds `KNOWN` and the pieces between dots, hyphens and
  digits, other than those made up of `KNOWN` words, that at least `MIN_HOSTS` different hosts contain. It stays a table:
  each distinct run is joined with the words that it contains.
- Classes are learnt from weak labels, as there are no others: a host whose words include one of `BLOCK_WORDS` counts as
  block, other hosts as allow. Token counts of both classes cover all pages, and every token keeps its weight, however
  rare. Multinomial naive Bayes with add-one smoothing then scores the tokens of host and path of every page, so words
  that go with blocked names tell as well. Counts, weights and scores are tables, joined by run, token and (host, path).

Null urls and urls without `://` have an empty host and path and no rule, no tokens, and the verdict of the class prior.
Repeated rows are judged each. Empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.llm.ship import ship
from agorascope.operators.lineage import cut as written
from agorascope.operators.skew import lookup_join

#: (verdict, host and path prefix)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MIN_HOSTS = 3
#: Rows that a task hands on at once.
ROWS = 50_000
# Words of names that are blocked, and common words that help to cut names.
BLOCK_WORDS = frozenset(
    "adult ads adserver adware bet bets betting bingo casino cheap click crack escort farm free gambling jackpot keygen "
    "loan loans lottery malware nude payday phishing pharma pills poker porn roulette sex slots spam torrent track "
    "tracker tracking viagra warez win winner xxx".split()
)
STRONG = frozenset(
    "adult ads adserver adware bet bets betting bingo casino escort gambling jackpot keygen lottery malware nude payday "
    "phishing pills poker porn roulette sex slots spam viagra warez xxx".split()
)
KNOWN = BLOCK_WORDS | frozenset(
    "about art best blog book books business buy car cars city club cloud code daily data design digital film food forum "
    "game games garden guide health help history home hotel house info job jobs kids life live local magazine mail market "
    "media mobile money movie music my net network news online open party people photo play post press radio real school "
    "science search secure service shop site social sport sports store story super team tech the time top tours town "
    "travel video view web wiki work world your".split()
)


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty if there is none."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("`_url`")))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("`_url`")))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + prefix))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def runs_of(name: str) -> list[str]:
    """The runs of letters of a name, in lower case."""
    return re.findall(r"[^\W\d_]+", name.lower())


def likeliest(run: str, cost: dict[str, float], unknown: float) -> list[str]:
    """The words of the cheapest cut of a run of letters; a piece that is no word costs `unknown` and 2.5 a letter."""
    n, longest = len(run), max(map(len, cost), default=0)
    best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
    least, since = math.inf, 0  # the best start of a piece that is no word
    for end in range(1, n + 1):
        start = end - 1
        if best[start] - 2.5 * start < least:
            least, since = best[start] - 2.5 * start, start
        best[end], back[end] = least + unknown + 2.5 * end, since
        for start in range(max(0, end - longest), end):
            price = cost.get(run[start:end])
            if price is not None and (best[start] + price, start) < (best[end], back[end]):
                best[end], back[end] = best[start] + price, start
    words, end = [], n
    while end:
        words.append(run[back[end] : end])
        end = back[end]
    return words[::-1]


class Segmenter:
    """Viterbi segmentation under a unigram model."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = sum(counts.values()) + 1 if total is None else total
        self.cost = {w: -math.log(n / total) for w, n in counts.items()}
        self.unknown = math.log(total) + 2.0
        self.cut = lru_cache(200_000)(self._cut)

    def _cut(self, run: str) -> tuple[str, ...]:
        return tuple(likeliest(run, self.cost, self.unknown))

    def words(self, name: str) -> list[str]:
        return [w for run in runs_of(name) for w in self.cut(run)]


def dictionary(hosts: DataFrame) -> DataFrame:
    """The written table (word, n) of words and the number of hosts that contain them."""
    pieces = hosts.select("host").distinct().select(F.explode(F.array_distinct(F.split("host", r"[^\p{L}]+"))).alias("word"))
    found = pieces.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_HOSTS)

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Segmenter({w: MIN_HOSTS for w in KNOWN})
        for batch in batches:
            # A name made up of known words is no word, however many hosts it has.
            yield batch[[w in KNOWN or not KNOWN >= set(model.cut(w)) for w in batch["word"]]]

    known = hosts.sparkSession.createDataFrame([(w, MIN_HOSTS) for w in sorted(KNOWN)], "word string, n long")
    every = found.mapInPandas(words, "word string, n long").unionByName(known)
    return written(every.groupBy("word").agg(F.max("n").alias("n")), "words")


def segmented(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """The written table (run, words) of distinct runs, cut by the words of (word, n)."""
    total, longest = counts.agg(F.sum("n") + 1, F.max(F.char_length("word"))).first()

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for run in batch["run"]:
                rows += [(run, word) for word in {run[a:b] for a in range(len(run)) for b in range(a + 1, min(len(run), a + longest) + 1)}]
                if len(rows) > ROWS:
                    yield pd.DataFrame(rows, columns=["run", "word"])
                    rows = []
            yield pd.DataFrame(rows, columns=["run", "word"])

    @F.pandas_udf("array<string>")
    def cut(runs: pd.Series, words: pd.Series, ns: pd.Series) -> pd.Series:
        out = []
        for run, own, n in zip(runs, words, ns, strict=True):
            own = {} if own is None else dict(zip(own, n, strict=True))
            out.append(list(Segmenter(own, total).cut(run)))
        return pd.Series(out, dtype=object)

    contained = lookup_join(runs.mapInPandas(parts, "run string, word string"), counts, ["word"])
    own = contained.groupBy("run").agg(F.collect_list(F.struct("word", "n")).alias("own"))
    return written(runs.join(own, "run", "left").select("run", cut("run", "own.word", "own.n").alias("words")), "segmented")


def _total(column: Column) -> Column:
    """The sum of collected numbers, in one order."""
    return F.aggregate(F.sort_array(F.collect_list(column)), F.lit(0.0), lambda a, x: a + x)


def scores(hosts_and_paths: DataFrame, counts: DataFrame) -> tuple[DataFrame, float]:
    """The table (host, path, tokens_odds) of distinct pairs that have tokens, and the log odds of the prior."""
    names = written(hosts_and_paths.groupBy("host", "path").agg(F.count("*").alias("pages")), "names")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, path, pages in batch.itertuples(index=False):
                for side, name in (("h:", host), ("p:", path)):
                    times: dict[str, int] = {}
                    for run in runs_of(name):
                        times[run] = times.get(run, 0) + 1
                    rows += [(host, path, pages, side, run, k) for run, k in times.items()]
            yield pd.DataFrame(rows, columns=["host", "path", "pages", "side", "run", "k"])

    runs = written(names.mapInPandas(split, "host string, path string, pages long, side string, run string, k long"), "runs")
    cuts = segmented(runs.select("run").distinct(), counts)
    strong = F.arrays_overlap("words", F.array(*[F.lit(w) for w in sorted(STRONG)]))
    blocking = cuts.filter(strong).select("run")
    # A pair's class: block if a word of its host is strong.
    block = lookup_join(runs.filter("side = 'h:'"), blocking, ["run"], "left_semi").select("host", "path").distinct()
    block = written(block.withColumn("block", F.lit(1)), "block")
    classed = runs.join(block, ["host", "path"], "left")
    n, is_block = F.col("pages") * F.col("k"), F.coalesce("block", F.lit(0))
    by_run = classed.groupBy("side", "run").agg(F.sum(n * is_block).alias("block"), F.sum(n * (1 - is_block)).alias("allow"))
    by_run = written(by_run.join(cuts, "run").select("side", "run", "words", "block", "allow"), "by_run")
    tokens = by_run.select("side", "run", "block", "allow", F.explode("words").alias("word")).withColumn("token", F.concat("side", "word"))
    sums = written(tokens.groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")), "tokens")
    all_block, all_allow, kinds = (x or 0 for x in sums.agg(F.sum("block"), F.sum("allow"), F.count("*") + 1).first())
    pages = names.agg(F.sum("pages")).first()[0] or 0
    pages_block = names.join(block, ["host", "path"]).agg(F.sum("pages")).first()[0] or 0
    weight = F.log((F.col("block") + 1) / F.lit(float(all_block + kinds))) - F.log((F.col("allow") + 1) / F.lit(float(all_allow + kinds)))
    weights = sums.select("token", weight.alias("weight"))
    of_run = lookup_join(tokens.select("side", "run", "token"), weights, ["token"], bound=sums)
    of_run = written(of_run.groupBy("side", "run").agg(_total(F.col("weight")).alias("weight")), "weights")
    found = lookup_join(runs.drop("pages"), of_run, ["side", "run"])
    odds = written(found.groupBy("host", "path").agg(_total(F.col("k") * F.col("weight")).alias("tokens_odds")), "odds")
    return odds, math.log((pages_block + 1) / (pages - pages_block + 1))


def judged(pages: DataFrame, url_column: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """All columns of `pages`, with host, path, rule, verdict and `block_odds` (log odds of block by the method).

    Columns of `pages` that have one of these names are replaced.
    """
    ship(pages.sparkSession)
    outputs = ("host", "path", "rule", "verdict", "block_odds", "_url")
    rest = pages.withColumn("_url", F.col(url_column).cast("string"))
    rest = rest.drop(*[c for c in pages.columns if c.lower() in outputs and c != url_column])
    cut = rest.withColumns({"host": host_of(F.col("_url")), "path": path_of(F.col("_url"))}).drop("_url")
    own = cut.select("host", "path")
    odds, prior = scores(own, dictionary(cut))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    found = lookup_join(cut, odds.withColumnRenamed("tokens_odds", "block_odds"), ["host", "path"], "left", keys_from=own)
    scored = found.select(*cut.columns, (F.lit(prior) + F.coalesce("block_odds", F.lit(0.0))).alias("block_odds"))
    method = F.when(F.col("block_odds") > 0, "block").otherwise("allow")
    return scored.withColumns({"rule": rule, "verdict": F.coalesce(verdict, method)})
