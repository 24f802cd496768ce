"""Toxicity by weak supervision.

1. Terms are mined from a bounded sample of labelled rows: whole words, word prefixes,
   prefixes that begin two words of a text, and those that begin many of its words, if they
   hold in so many more toxic texts than others that chance, over all candidates, explains
   it in one case of a hundred.
2. Voters: each term is one; so is each theme of a fixed lexicon in four languages, each
   theme of fixed phrases, and each pattern of style. Some speak for toxic texts, some for
   clean ones. A voter votes or abstains.
3. A generative label model: voters vote with a probability that depends on the class and,
   for correlated voters, on whether the voter they lean on votes. Which lean on which is a
   maximum spanning forest over their mutual information given the class. All
   probabilities are fitted by expectation maximisation on the vote sets of all texts; labelled rows
   keep their label. Each step is a Spark aggregation, of which sums a voter reach the driver.
4. A linear classifier on the votes is trained on the posterior labels of all vote sets, each
   as heavy as it is frequent, and scores every text.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize

WORD = re.compile(r"[^\W\d_]+")
#: Themes of insulting words, in English, German, French and Spanish.
LEXICON = {
    "stupidity": "idiot idiots moron morons stupid imbecile dimwit dumb fool idiota estúpido estúpida imbécil tonto idiote imbécile stupide crétin abruti débile trottel dummkopf blöd depp",
    "worthlessness": "worthless loser losers pathetic useless trash garbage scum vermin degenerate inútil basura perdedor patético escoria minable ordure vermine wertlos versager abschaum erbärmlich",
    "disgust": "disgusting filthy repulsive asqueroso repugnante dégoûtant répugnant ekelhaft widerlich",
    "mockery": "clown clowns freak weirdo payaso bouffon guignol hampelmann witzfigur",
    "vulgarity": "bastard asshole bitch shit fuck fucking cabrón mierda puta gilipollas connard salaud merde putain arschloch scheiße wichser hurensohn",
}
#: Themes of phrases.
PHRASES = {
    "threat": ("kill you", "kill yourself", "go die", "bring dich um", "te voy a matar", "vais te tuer"),
    "silencing": ("shut up", "halt die klappe", "ta gueule", "cállate"),
    "courtesy": ("thank you", "please ", "danke", "merci", "gracias"),
    "reference": ("http://", "https://", "license", "copyright"),
}
#: Voters of which a vote speaks for a clean text.
CLEAN = ("courtesy", "reference", "plain")
STYLES = ("shouting", "exclaiming", "stretching", "masking", "plain")
STRETCHED, MASKED = re.compile(r"([a-z])\1\1\1"), re.compile(r"\b[a-z]\*+[a-z]*\b")
WHOLE, TWICE, OFTEN = "$", "*", "%"
#: A prefix is frequent in a text if it begins two or more and one of so many of its distinct words.
ONE_OF = 64
SHORTEST, LONGEST = 3, 9
#: Candidates for terms are looked up in a bitmap of so many slots while clean texts are counted.
SLOTS = 1 << 20
#: What a voter is taken for before any text is seen: the chance of a vote in a toxic and in a clean text, worth so many texts.
PRIOR, PRIOR_CLEAN, PRIOR_TEXTS = (0.1, 0.005), (0.02, 0.05), 20.0
#: Labelled rows weigh as much as this share of all rows, if they are fewer.
ANCHOR = 0.25
ROUNDS, CLOSE = 12, 1e-3
#: Vote sets of a partition, about, and the least partitions.
SETS, LEAST_PARTS = 1 << 16, 8


def distinct_words(text: str | None) -> tuple[set[str], float]:
    """The distinct words of a text, lower-cased, and the share of those of three letters or more that are capitals throughout."""
    words = set(WORD.findall(text or ""))
    long = [w for w in words if len(w) > 2]
    return {w.lower() for w in words}, sum(map(str.isupper, long)) / len(long) if long else 0.0


def features(text: str | None) -> set[str]:
    """The words of a text, marked as whole; prefixes of 3 to 9 letters of its words; and, marked, those that begin two words or more, and of these the frequent ones."""
    words, begun = distinct_words(text)[0], {}
    for w in words:
        for k in range(SHORTEST, min(LONGEST, len(w)) + 1):
            begun[w[:k]] = begun.get(w[:k], 0) + 1
    several = {p: n for p, n in begun.items() if n > 1}
    return {w + WHOLE for w in words} | set(begun) | {p + TWICE for p in several} | {p + OFTEN for p, n in several.items() if ONE_OF * n >= len(words)}


def slot(term: Column) -> Column:
    return F.pmod(F.crc32(term.cast("binary")), F.lit(SLOTS)).cast("int")


def mine(sample: DataFrame, sizes: dict[int, int], base: float, precision: float = 0.6) -> dict[str, float]:
    """The terms that tell toxic texts, with their log likelihood ratios, from rows (text, toxic), `sizes` of them by label; `base`: the share of toxic rows at large.

    A candidate holds in three toxic texts. Clean texts are counted only for what falls in the
    slots of candidates; the exact join that follows leaves no other. Only terms that pass reach the driver.
    """
    import zlib

    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return {}

    def count(rows: DataFrame, wanted=None) -> DataFrame:
        def of(batches):
            for pdf in batches:
                counts: dict[str, int] = {}
                for t in pdf["text"]:
                    for f in features(t):
                        if wanted is None or f in counts or wanted.value[zlib.crc32(f.encode()) % SLOTS]:
                            counts[f] = counts.get(f, 0) + 1
                yield pd.DataFrame({"f": list(counts), "n": list(counts.values())}, columns=["f", "n"]).astype({"n": "int64"})

        return rows.select("text").mapInPandas(of, "f string, n long").groupBy("f").agg(F.sum("n").alias("n"))

    toxic = materialize(count(sample.where("toxic = 1")).where("n >= 3"))
    candidates = toxic.count()
    bitmap = np.zeros(SLOTS, bool)
    bitmap[[r[0] for r in toxic.select(slot(F.col("f"))).distinct().collect()]] = True  # at most SLOTS numbers
    clean = count(sample.where("toxic = 0"), sample.sparkSession.sparkContext.broadcast(bitmap))
    both = toxic.join(clean.select("f", F.col("n").alias("m")), "f", "left").select("f", "n", F.coalesce("m", F.lit(0)).alias("m"))
    n, m, total = F.col("n").cast("double"), F.col("m").cast("double"), float(bad + good)
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    ratio = part(n, (n + m) * bad / total) + part(m, (n + m) * good / total)
    ratio = ratio + part(bad - n, (total - n - m) * bad / total) + part(good - m, (total - n - m) * good / total)
    sure = (F.col("ratio") > math.log(100 * max(1, candidates))) & (n / bad * base >= precision * (n / bad * base + m / good * (1 - base)))
    return {r["f"]: r["ratio"] for r in both.withColumn("ratio", ratio).where(sure).select("f", "ratio").collect()}


def best_of_chains(ratios: dict[str, float]) -> list[str]:
    """Of words and prefixes that begin with one another the surest alone; so of the prefixes that begin two words, and of the frequent ones."""
    out: list[str] = []
    for kind in (None, TWICE, OFTEN):
        stems: set[str] = set()
        mine = (f for f in ratios if (f[-1] if f[-1] in (TWICE, OFTEN) else None) == kind)
        for f in sorted(mine, key=lambda f: (-ratios[f], -len(f), f)):
            stem = f.rstrip(WHOLE + TWICE + OFTEN)
            nested = any(stem[:k] in stems for k in range(SHORTEST, len(stem) + 1)) or any(s.startswith(stem) for s in stems)
            if not nested:
                stems.add(stem)
                out.append(f)
    return out


@dataclass
class Voting:
    """The voters; turns a text into the numbers of those that vote. Terms come first, then lexicon, phrases and styles."""

    terms: list[str]
    names: list[str] = field(init=False)

    def __post_init__(self):
        self.names = [*self.terms, *LEXICON, *PHRASES, *STYLES]
        place = {n: i for i, n in enumerate(self.names)}
        self.prefix = {t: i for i, t in enumerate(self.terms) if not t.endswith((WHOLE, TWICE, OFTEN))}
        self.twice, self.often = ({t[:-1]: i for i, t in enumerate(self.terms) if t.endswith(kind)} for kind in (TWICE, OFTEN))
        self.whole: dict[str, list[int]] = {}
        for i, t in enumerate(self.terms):
            if t.endswith(WHOLE):
                self.whole.setdefault(t[:-1], []).append(i)
        for theme, words in LEXICON.items():
            for w in words.split():
                self.whole.setdefault(w, []).append(place[theme])
        self.heads = {t[:SHORTEST] for t in (*self.prefix, *self.twice, *self.often)}
        self.phrases = [(place[theme], phrases) for theme, phrases in PHRASES.items()]
        self.styles = [place[s] for s in STYLES]

    def __call__(self, text: str | None) -> list[int]:
        text = text or ""
        (words, capitals), lower = distinct_words(text), text.lower()
        fired: set[int] = set()
        begun: dict[str, int] = {}
        for w in words:
            fired.update(self.whole.get(w, ()))
            if w[:SHORTEST] in self.heads:
                for k in range(SHORTEST, min(LONGEST, len(w)) + 1):
                    begun[w[:k]] = begun.get(w[:k], 0) + 1
        fired.update(self.prefix[p] for p in begun if p in self.prefix)
        fired.update(self.twice[p] for p, n in begun.items() if n > 1 and p in self.twice)
        fired.update(self.often[p] for p, n in begun.items() if n > 1 and ONE_OF * n >= len(words) and p in self.often)
        fired.update(i for i, phrases in self.phrases if any(p in lower for p in phrases))
        marks = lower.count("!")
        styles = (capitals > 0.5, "!!" in lower, STRETCHED.search(lower), "*" in lower and MASKED.search(lower), len(words) >= 50 and not marks and capitals < 0.1)
        fired.update(i for i, s in zip(self.styles, styles, strict=True) if s)
        return sorted(fired)


def spread(votes: pd.Series, voters: int) -> np.ndarray:
    """A row a vote set, a column a voter, 1 where it votes."""
    x = np.zeros((len(votes), voters), np.float64)
    for i, v in enumerate(votes):
        x[i, np.asarray(v, int)] = 1
    return x


@dataclass
class LabelModel:
    """`leans[j]`: the voter that voter j leans on, or -1. `vote[c, s, j]`: the chance that j votes in a text of class c when that voter abstains (s = 0) or votes (s = 1). `share`: of toxic texts."""

    leans: np.ndarray
    vote: np.ndarray
    share: float

    def beside(self, x: np.ndarray) -> np.ndarray:
        return np.where(self.leans >= 0, x[:, self.leans], 0.0)

    def posterior(self, x: np.ndarray) -> np.ndarray:
        """The chance that each vote set, a row of `x`, is that of a toxic text."""
        yes, no, by = np.log(self.vote), np.log(1 - self.vote), self.beside(x)
        logs = []
        for c in (0, 1):
            z = no[c, 0].sum() + x @ (yes[c, 0] - no[c, 0]) + by @ (no[c, 1] - no[c, 0]) + (x * by) @ (yes[c, 1] - no[c, 1] - yes[c, 0] + no[c, 0])
            logs.append(z + math.log(self.share if c else 1 - self.share))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))

    def weights(self, pdf: pd.DataFrame, x: np.ndarray) -> np.ndarray:
        """(2, rows): how much of each row belongs to either class; labelled rows belong to theirs."""
        post = np.where(pdf["label"].isna(), self.posterior(x), pdf["label"].fillna(0).to_numpy(float))
        n = pdf["n"].to_numpy(float)
        return np.stack([n * (1 - post), n * post])


def priors(names: list[str]) -> np.ndarray:
    """(2, voters): the chance of a vote in a clean and in a toxic text before any is seen."""
    return np.array([(PRIOR_CLEAN if n in CLEAN else PRIOR)[::-1] for n in names]).reshape(-1, 2).T


#: So many distinct vote sets, of a few numbers each, are gathered and fitted in memory; more stay a table, over which each round is a job.
HELD = 1 << 16


def sums(sets: DataFrame | pd.DataFrame, of, size: int) -> np.ndarray:
    """The sum over all batches of `sets`, a table or gathered, of the vectors of `size` numbers that `of` makes of each; zeros are not moved."""
    if isinstance(sets, pd.DataFrame):
        return sum((of(sets.iloc[i : i + 4096]) for i in range(0, len(sets), 4096)), np.zeros(size))

    def parts(batches):
        for pdf in batches:
            v = of(pdf)
            at = np.flatnonzero(v)
            yield pd.DataFrame({"k": at, "v": v[at]})

    out = np.zeros(size)
    for r in sets.mapInPandas(parts, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[r["k"]] = r["v"]
    return out


def maximise(sets: DataFrame | pd.DataFrame, model: LabelModel, names: list[str], rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation from `model` on, with its correlations as they are."""
    v, prior = len(names), priors(names)

    for _ in range(rounds):
        at = model

        def expected(pdf: pd.DataFrame, at: LabelModel = at) -> np.ndarray:
            x = spread(pdf["votes"], v)
            by, w = at.beside(x), at.weights(pdf, x)
            return np.concatenate([w.sum(axis=1), (w @ x).ravel(), (w @ by).ravel(), (w @ (x * by)).ravel()])

        got = sums(sets, expected, 2 + 6 * v)
        mass, fires, leant, both = got[:2], *got[2:].reshape(3, 2, v)
        seen = np.stack([mass[:, None] - leant, leant], axis=1)
        told = np.stack([fires - both, both], axis=1)
        # Where the other voter votes, what is known before is what holds where it abstains.
        first = (told[:, 0] + PRIOR_TEXTS * prior) / (seen[:, 0] + PRIOR_TEXTS)
        second = (told[:, 1] + PRIOR_TEXTS * first) / (seen[:, 1] + PRIOR_TEXTS)
        vote = np.clip(np.stack([first, second], axis=1), 1e-7, 1 - 1e-7)
        model = LabelModel(model.leans, vote, float(np.clip((mass[1] + 1) / (mass.sum() + 20), 1e-6, 1 - 1e-6)))
        if np.abs(model.vote - at.vote).max() < CLOSE:
            break
    return model


def correlations(sets: DataFrame | pd.DataFrame, model: LabelModel, least: float = 0.05) -> np.ndarray:
    """For each voter that on which it leans, or -1: a maximum spanning forest over the voters' mutual information given the class.

    Only pairs whose correlation within a class is `least` or more count.
    """
    v = model.vote.shape[2]

    def pairs(pdf: pd.DataFrame) -> np.ndarray:
        x = spread(pdf["votes"], v)
        w = model.weights(pdf, x)
        return np.concatenate([w.sum(axis=1), *[((x * c[:, None]).T @ x).ravel() for c in w]])

    got = sums(sets, pairs, 2 + 2 * v * v)
    info, related = np.zeros((v, v)), np.zeros((v, v))
    for mass, both in zip(got[:2], got[2:].reshape(2, v, v), strict=True):
        if mass <= 1:
            continue
        one = np.diag(both) / mass
        joint = both / mass
        sd = np.sqrt((one * (1 - one)).clip(1e-12))
        related = np.maximum(related, np.abs(joint - np.outer(one, one)) / np.outer(sd, sd))
        for a, b, p in ((one, one, joint), (one, 1 - one, one[:, None] - joint), (1 - one, one, one - joint), (1 - one, 1 - one, 1 - one[:, None] - one + joint)):
            p = p.clip(1e-12)
            info += mass * p * np.log(p / np.outer(a, b).clip(1e-12))
    group = list(range(v))

    def root(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    beside: dict[int, list[int]] = {i: [] for i in range(v)}
    order = sorted(((-info[i, j], i, j) for i in range(v) for j in range(i) if related[i, j] >= least and info[i, j] > 0))
    for _, i, j in order:
        if root(i) != root(j):
            group[root(i)] = root(j)
            beside[i].append(j), beside[j].append(i)
    leans, done = np.full(v, -1), set()
    for start in range(v):
        todo = [] if start in done else [(start, -1)]
        while todo:
            i, above = todo.pop()
            leans[i] = above
            done.add(i)
            todo += [(j, i) for j in beside[i] if j not in done]
    return leans


def label_model(sets: DataFrame | pd.DataFrame, names: list[str]) -> LabelModel:
    """The model of rows (votes, label, n): first with independent voters, then with the correlations these show."""
    v = len(names)
    model = LabelModel(np.full(v, -1), np.repeat(priors(names)[:, None, :], 2, axis=1), 0.05)
    model = maximise(sets, model, names)
    return maximise(sets, LabelModel(correlations(sets, model), model.vote, model.share), names)


def fitted_here(sets: pd.DataFrame, model: LabelModel, strength: float = 1e-5) -> tuple[list[float], float]:
    """The logistic regression of `classifier` on gathered vote sets, by Newton steps: a set as heavy as it is frequent, the weights drawn to zero, the bias not."""
    v = model.vote.shape[2]
    known = sets[sets["label"].isna()]
    x = np.column_stack([spread(known["votes"], v), np.ones(len(known))]).astype(np.float64)
    n, y = known["n"].to_numpy(np.float64), model.posterior(spread(known["votes"], v))
    n, ridge, at = n / n.sum(), np.append(np.full(v, strength), 0.0), np.zeros(v + 1)
    loss = lambda b: float(n @ (np.logaddexp(0, x @ b) - y * (x @ b)) + 0.5 * (ridge * b * b).sum())
    for _ in range(100):
        p = 1 / (1 + np.exp(-(x @ at)))
        slope = x.T @ (n * (p - y)) + ridge * at
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-12)
        step, size = np.linalg.solve(bend, slope), 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return at[:v].tolist(), float(at[v])


def classifier(sets: DataFrame | pd.DataFrame, model: LabelModel) -> tuple[list[float], float]:
    """(weights of the voters, bias): a logistic regression on the posterior labels, a vote set as heavy as it is frequent."""
    if isinstance(sets, pd.DataFrame):
        return fitted_here(sets, model)
    v = model.vote.shape[2]

    @F.pandas_udf("double")
    def posterior(votes: pd.Series) -> pd.Series:
        return pd.Series(model.posterior(spread(votes, v)))

    known = sets.where("label is null").withColumn("post", posterior("votes"))
    x = array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(v - 1)), lambda i: F.array_contains("votes", i).cast("double")))
    soft = known.select(x.alias("features"), F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("post")).alias("weight")), F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("post"))).alias("weight")))).alias("y"))
    soft = materialize(soft.select("features", "y.*"))
    fitted = LogisticRegression(maxIter=40, regParam=1e-5, standardization=False, tol=1e-7, weightCol="weight", family="binomial").fit(soft)
    return [float(w) for w in fitted.coefficients], float(fitted.intercept)


def toxicity(df: DataFrame, text: str, labelled: DataFrame, label: str, labelled_text: str = "text", max_rows: int = 20_000) -> DataFrame:
    """Add `score` (0 to 1), `predicted` (1 if score >= 0.5) and `votes` (voters for toxic that vote, long) to the rows of `df`, without their texts.

    `labelled` has rows with a 0/1 `label`, others are ignored: about `max_rows` of them teach,
    half of either label where there are as many, chosen by a hash of their text. Null and
    empty texts have no votes and get the score of a text without evidence. Repeated rows
    count each. Without labels of both classes the fixed voters vote alone. An empty table
    gives an empty result; columns with the added names are replaced.
    """
    df = df.drop("score", "predicted", "votes")
    known = labelled.select(F.coalesce(labelled_text, F.lit("")).alias("text"), F.col(label).cast("int").alias("toxic")).where("toxic in (0, 1)")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = {y: min(1.0, max_rows / 2 / n) for y, n in sizes.items()}
    part = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / (1 << 30)
    picked = F.lit(False)
    for y, s in share.items():
        picked = F.when(F.col("toxic") == y, part < s).otherwise(picked)
    sample = materialize(known.where(picked).repartition(32) if sizes else known)
    taken = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    base = sizes.get(1, 0) / max(1, sum(sizes.values()))
    voting = Voting(best_of_chains(mine(sample, taken, base)))

    @F.pandas_udf("array<int>")
    def vote(texts: pd.Series) -> pd.Series:
        return pd.Series([voting(t) for t in texts], dtype=object)

    voted = free_name(df, "voted")
    rows = materialize(df.withColumn(voted, vote(F.col(text))).drop(text))
    seen = rows.groupBy(F.col(voted).alias("votes")).agg(F.count("*").cast("double").alias("n"), F.lit(None).cast("int").alias("label"))
    total = rows.count()
    # A labelled row stands for those of its label that were not sampled; all together weigh ANCHOR of all rows or more.
    stands = {y: sizes[y] / taken[y] for y in taken}
    anchor = max(1.0, ANCHOR * total / max(1, sum(sizes.values())))
    weigh = F.lit(0.0)
    for y, s in stands.items():
        weigh = F.when(F.col("toxic") == y, s * anchor).otherwise(weigh)
    taught = sample.select(vote("text").alias("votes"), F.col("toxic").alias("label"), weigh.alias("w")).groupBy("votes", "label").agg(F.sum("w").alias("n"))
    sets = materialize(seen.select("votes", "label", "n").unionByName(taught.select("votes", "label", "n")))
    # The rounds read it again and again: in memory if it is small, else in partitions by its size, not by those of the shuffle before.
    n_sets = sets.count()
    sets = sets.toPandas() if n_sets <= HELD else sets.coalesce(max(LEAST_PARTS, -(-n_sets // SETS)))
    weights, bias = classifier(sets, label_model(sets, voting.names)) if total else ([0.0] * len(voting.names), 0.0)
    of = F.lit(weights)
    z = F.aggregate(F.col(voted), F.lit(bias), lambda a, j: a + F.element_at(of, j + 1))
    speaks = F.lit([n not in CLEAN for n in voting.names])
    rows = rows.withColumn("score", 1 / (1 + F.exp(-z)))
    votes = F.size(F.filter(F.col(voted), lambda j: F.element_at(speaks, j + 1))).cast("long")
    return rows.withColumns({"predicted": (F.col("score") >= 0.5).cast("int"), "votes": votes}).drop(voted)
