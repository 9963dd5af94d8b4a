"""Quality rules as weak supervision, in DataFrame functions only.

Each rule votes good (1) or bad (-1) or abstains (0) on a document's counts. Documents with the same votes are one pattern, so
the vote table has 3^rules rows at most whatever the input: 177,147 for the 11 rules that there may be, some hundreds in practice.
Expectation-maximisation over the patterns estimates the share of good documents and how often each rule votes good, bad or not
at all on good and on bad ones; a document is kept if its posterior probability of being good under that model reaches the
threshold and the hard base rules do not fail it. The model is fitted on the documents that it decides on, those that pass the
base. The default rules vote both ways and several look at each kind of fault, so
that a rule's votes can be held against the others': one rule's fault alone seldom decides, agreeing ones do.

Counts: n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word equal to an earlier line) and
n_repeat_words (words inside a five-word window that occurs twice or more in the text); for the rules also n_lines, n_upper,
n_digits, n_symbol_words (words with a symbol), n_symbol_runs, n_shouts, n_stutter (words equal to the one before) and n_distinct.
Defined cases: null and empty texts have all counts 0, so the base fails; ties of the posterior with the threshold are kept;
an empty table gives an empty result; repeated rows and null ids are judged like others; other columns are never read; a rule
whose vote is null abstains; more than 11 rules raise ValueError.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stash

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def repeat_words(words: Column, size: int = WINDOW) -> Column:
    """Words covered by windows that occur twice or more. Equal hashes are neighbours once sorted; hashes carry 64 bits."""

    def covered(sorted_windows: Column) -> Column:
        def repeated(x, k):
            same = lambda y: F.coalesce(y["h"] == x["h"], F.lit(False))
            return F.when(same(F.get(sorted_windows, k + 1)) | same(F.get(sorted_windows, k - 1)), x["p"])

        places = F.sort_array(F.array_compact(F.transform(sorted_windows, repeated)))
        width = lambda at: F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-1).alias("to")), lambda acc, p: F.struct((acc["n"] + p + size - F.greatest(p, acc["to"])).alias("n"), (p + size).alias("to")), lambda acc: acc["n"])
        return let(places, width)

    def by_windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda k: F.xxhash64(*(F.get(w, k + j) for j in range(size))))

        def maybe(h: Column) -> Column:
            placed = F.sort_array(F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("p"))))
            return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(placed, covered))

        return let(hashes, maybe)

    return let(words, lambda w: F.when(F.size(w) <= size, F.lit(0)).otherwise(by_windows(w)))


def counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    blank = r"[\x20\x09-\x0D]+"
    solid = F.btrim(text, F.lit(SPACES))
    words = F.when(solid == "", F.array().cast("array<string>")).otherwise(F.split(solid, blank))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    stutter = lambda w: F.size(F.filter(w, lambda x, k: F.coalesce(x == F.get(w, k - 1), F.lit(False))))
    of_words = lambda w: {"n_words": F.size(w), "word_chars": F.aggregate(w, F.lit(0), lambda n, x: n + F.length(x)), "n_repeat_words": repeat_words(w), "n_stutter": stutter(w), "n_distinct": F.size(F.array_distinct(w))}
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.regexp_count(text, F.lit(rf"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(words, lambda w: F.struct(*(c.cast("long").alias(n) for n, c in of_words(w).items()))).alias("w"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>][^\x20\x09-\x0D]*")).cast("long").alias("n_symbol_words"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]{2,}")).cast("long").alias("n_symbol_runs"),
        F.regexp_count(text, F.lit(r"[!?]{2,}")).cast("long").alias("n_shouts"),
    ).select("doc_id", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words", "n_lines", "n_upper", "n_digits", "n_symbol_words", "n_symbol_runs", "n_shouts", "w.n_stutter", "w.n_distinct")


def share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def up_to(x: Column, good: float, bad: float) -> Column:
    """Votes good under the one bound, bad from the other one on, and abstains between."""
    return F.when(x < good, 1).when(x >= bad, -1).otherwise(0)


def default_rules() -> dict[str, Column]:
    """name -> its vote: 1 good, -1 bad, 0 abstains. Three look at symbols, four at repetition, four at the shape of words."""
    word = share("word_chars", "n_words")
    variety = F.col("n_distinct") / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    return {
        "symbols": up_to(share("n_symbols", "word_chars"), 0.02, 0.06),
        "symbol_words": up_to(share("n_symbol_words", "n_words"), 0.05, 0.2),
        "symbol_runs": up_to(share("n_symbol_runs", "n_words"), 0.02, 0.1),
        "repeats": up_to(share("n_repeat_words", "n_words"), 0.1, 0.15),
        "lines": F.when(F.col("n_dup_lines") == 1, 0).otherwise(up_to(share("n_dup_lines", "n_lines"), 0.12, 0.3)),  # one may be a heading
        "stutter": up_to(share("n_stutter", "n_words"), 0.1, 0.2),
        "variety": F.when(variety >= 3, 1).when(variety < 2.2, -1).otherwise(0),
        "capitals": up_to(share("n_upper", "word_chars"), 0.15, 0.3),
        "shouts": up_to(share("n_shouts", "n_words"), 0.02, 0.1),
        "digits": up_to(share("n_digits", "word_chars"), 0.05, 0.2),
        "word_length": F.when(word.between(3, 10), 1).when((word <= 2) | (word >= 14), -1).otherwise(0),
    }


class Estimate:
    """Label model: the share of good documents and, for good and for bad ones, how often each rule votes good, bad or not at all.

    Expectation-maximisation over (votes, number of documents). The first round takes a rule's vote on a good document as right
    with probability `belief`, on a bad one with `finds` (belief, if none is given): a bad document need not have every fault, so
    rules that look at other faults call it good. Abstentions say nothing in the first round; after it the data decide, of votes and of
    abstentions alike, and what is fitted is what judges. The prior is a fixed number of documents: `weight` of each kind, on which
    a rule votes as often as it does over all and is right with those shares, and one of each kind on the share of good ones. It keeps
    estimates off 0 and 1 and rules with a few votes near the belief; any more data outweighs it. A rule without votes says nothing."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 30, belief: float = 0.97, weight: float = 4.0, finds: float | None = None):
        total = sum(n for _, n in patterns)
        cast = [sum(n for votes, n in patterns if votes[k]) for k in range(rules)]
        right = {1: belief, -1: belief if finds is None else finds}
        given = {(c, v): right[c] if c == v else 1 - right[c] for c in (1, -1) for v in (1, -1)}
        self.prior, self.accuracy = 0.8, [belief] * rules
        self.odds = [{0: 0.0, **{v: math.log(given[1, v] / given[-1, v]) for v in (1, -1)}} for _ in range(rules)]
        for _ in range(rounds if total else 0):
            good = [(votes, n, self.posterior(votes)) for votes, n in patterns]
            of = {1: sum(n * p for _, n, p in good), -1: sum(n * (1 - p) for _, n, p in good)}
            for k in (k for k in range(rules) if cast[k]):
                rate = cast[k] / total
                seen = {(c, v): 0.0 for c in (1, -1) for v in (1, 0, -1)}
                for votes, n, p in good:
                    seen[1, votes[k]] += n * p
                    seen[-1, votes[k]] += n * (1 - p)
                share = {(c, v): (x + weight * (rate * given[c, v] if v else 1 - rate)) / (of[c] + weight) for (c, v), x in seen.items()}
                self.odds[k] = {v: math.log(share[1, v] / share[-1, v]) if share[1, v] and share[-1, v] else 0.0 for v in (1, 0, -1)}
                self.accuracy[k] = (seen[1, 1] + seen[-1, -1] + weight * belief) / (cast[k] + weight)
            self.prior = (of[1] + 1) / (total + 2)

    def log_odds(self, votes) -> float:
        return math.log(self.prior / (1 - self.prior)) + sum(odds[v] for v, odds in zip(votes, self.odds, strict=True))

    def posterior(self, votes) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.log_odds(votes)))))

    def column(self, names) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, by in zip(names, self.odds, strict=True):
            odds = odds + F.when(F.col(name) > 0, by[1]).when(F.col(name) < 0, by[-1]).otherwise(by[0])
        return 1 / (1 + F.exp(-odds))


MOST = 11
BELIEF, FINDS = 0.98, 0.3


def judge(docs: DataFrame, *, id_col="doc_id", text_col="text", threshold: float = 0.5, rules=None) -> DataFrame:
    """Per row the counts, base_failed, quality (the posterior) and kept. rules: name -> vote, a column of 1, -1 or 0 over the counts."""
    rules = default_rules() if rules is None else rules
    if len(rules) > MOST:
        raise ValueError(f"{len(rules)} rules, {MOST} at most")
    names = [f"vote_{x}" for x in rules]
    known = stash(counts(docs, id_col, text_col), "quality-counts")
    voted = known.select("*", *(F.coalesce(F.signum(vote).cast("int"), F.lit(0)).alias(n) for n, vote in zip(names, rules.values(), strict=True)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    table = voted.where(~failed).groupBy(*names).count().collect()  # one row a pattern: 3^MOST at most
    model = Estimate([(tuple(r[:-1]), r[-1]) for r in sorted(map(tuple, table))], len(names), belief=BELIEF, finds=FINDS)
    out = voted.withColumn("base_failed", failed).withColumn("quality", model.column(names))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)).select(*known.columns, "base_failed", "quality", "kept")
