"""Toxicity scores by weak supervision.

Many voters look at a text: fixed lexicons, lexicons mined from labelled rows, and patterns. A
generative label model with a hidden class estimates how accurate each voter is, and how voters
hang together, from the votes on all documents. Its posterior is the label on which a linear
classifier over words and word beginnings is trained, and that classifier gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.llm.common import measured, scratch_names, small_batches

ABSTAIN, TOXIC, CLEAN = 0, 1, 2
PREFIXES = (3, 4, 5, 6, 7, 8)

LEXICONS = {
    "insults": "idiot idiots moron morons imbecile imbeciles fool fools clown clowns loser losers "
    "dumbass retard retards halfwit cretin dunce jerk jerks",
    "contempt": "stupid pathetic worthless disgusting useless dumb brainless revolting repulsive "
    "despicable filthy vile braindead",
    "dehumanising": "scum trash garbage vermin parasite parasites subhuman subhumans cockroaches "
    "filth scumbag scumbags maggot maggots",
    "profanity": "fuck fucking fucked fucker fuckers shit shitty bullshit bitch bitches bastard "
    "bastards asshole assholes cunt cunts dickhead prick whore slut motherfucker",
    "threats": "kys lynch exterminate murderers strangle behead",
    "other_languages": "idioten arschloch scheisse scheiße dummkopf wichser hurensohn connard "
    "connards salope enculé imbécile imbéciles abruti abrutis idiota idiotas estúpido estúpida "
    "gilipollas cabrón puta mierda pendejo",
}
PATTERNS = {
    "addressed": r"\b(?:you|ye|u)\b(?:'?re| are| is)?(?: \w+){0,3} (?:idiot|moron|loser|clown|"
    r"scum|trash|fool|jerk|stupid|pathetic|worthless|disgusting)",
    "wish": r"\b(?:go|should|must|will|hope you) (?:and )?(?:die|rot|burn|hang)\b|\bkill yourself\b",
    "shouted": r"[A-Z]{3,}(?:\s+[A-Z]{3,}){3,}\s*!{2,}",
}
#: Words and beginnings that a text must hold for a pattern to fit; they only save time.
ADDRESSEES = frozenset(("you", "ye", "u"))
ABUSE = tuple("idiot moron loser clown scum trash fool jerk stupid pathetic worthless disgusting".split())
WISHES = frozenset(("die", "rot", "burn", "hang"))
#: Letters that stand for i or s where case is ignored, but not in lower case.
ODD_LETTERS = "\u0130\u0131\u017f"


def is_held_out(id_column: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


_WORD = re.compile(r"\w+")


def text_features(text: str) -> set[str]:
    """Distinct words, and their beginnings marked with their length."""
    found = set(_WORD.findall(text.lower()))
    features = set(found)
    for size in PREFIXES:
        features |= {f"{size}:{w[:size]}" for w in found if len(w) >= size}
    return features


class WordIndex:
    """Which of the ``wanted`` features each word brings; the words met first are remembered."""

    def __init__(self, wanted: frozenset, memory: int = 100_000):
        self.wanted, self.memory = wanted, memory
        self.known: dict[str, tuple] = {}

    def of(self, word: str) -> tuple:
        found = self.known.get(word)
        if found is None:
            beginnings = (f"{k}:{word[:k]}" for k in PREFIXES if len(word) >= k)
            found = tuple(f for f in (word, *beginnings) if f in self.wanted)
            if len(self.known) < self.memory:
                self.known[word] = found
        return found


#: Features that say how many words of the mined and fixed lexicons a text holds.
LADDER = ((1, "#1"), (2, "#2"), (3, "#3"), (5, "#5"))


@dataclass
class Voters:
    """All voters as one picklable object; ``mined`` maps a voter's name to its features."""

    mined: dict[str, frozenset] = field(default_factory=dict)

    def __post_init__(self):
        self.lexicons = {k: frozenset(v.split()) for k, v in LEXICONS.items()}
        self.all_words = frozenset().union(*self.lexicons.values())
        self.patterns = {
            k: re.compile(p, re.I if k != "shouted" else 0) for k, p in PATTERNS.items()
        }
        self.pattern_features = [f"/{k}" for k in PATTERNS]
        self.toxic = self.all_words.union(*self.mined.values())
        self.names = [*self.lexicons, *self.mined, "repeated", *PATTERNS, "spotless"]

    def features(self, text: str, index: WordIndex) -> set[str]:
        """Features of a text that ``index`` wants, the ladder and the patterns that fit.

        ``index`` must want ``toxic``.
        """
        found: set[str] = set()
        count = 0
        lowered = text.lower()
        words = set(_WORD.findall(lowered))
        for word in words:
            mine = index.of(word)
            if mine:
                found.update(mine)
                count += not self.toxic.isdisjoint(mine)
        found.update(name for least, name in LADDER if count >= least)
        found.update(f"/{k}" for k in self._fitting(text, lowered, words))
        return found

    def _fitting(self, text: str, lowered: str, words: set[str]) -> list[str]:
        """The patterns that fit somewhere in the whole text, with or without a lexicon word."""
        odd = any(c in text for c in ODD_LETTERS)
        possible = {
            "addressed": not words.isdisjoint(ADDRESSEES) and any(w in lowered for w in ABUSE),
            "wish": not words.isdisjoint(WISHES) or "kill yourself" in lowered,
            "shouted": "!!" in text,
        }
        return [k for k, p in self.patterns.items() if (odd or possible[k]) and p.search(text)]

    def votes(self, features: set[str]) -> str:
        """One character for each voter; ``features`` as given by ``features``."""
        out = []
        hits = features & self.all_words
        for words in self.lexicons.values():
            out.append(TOXIC if hits & words else ABSTAIN)
        for mined in self.mined.values():
            out.append(CLEAN if features.isdisjoint(mined) else TOXIC)
        out.append(TOXIC if "#3" in features else ABSTAIN)
        out += [TOXIC if f in features else ABSTAIN for f in self.pattern_features]
        spotless = "#1" not in features and features.isdisjoint(self.pattern_features)
        out.append(CLEAN if spotless else ABSTAIN)
        return "".join(map(str, out))


@dataclass
class LabelModel:
    """Hidden class, and a tree of voters: each voter depends on the class and one other voter.

    The tree holds the strongest dependences that remain once the class is known. ``tables``
    has P(vote | parent's vote, class) for each voter.
    """

    rounds: int = 30
    smoothing: float = 0.5

    def fit(self, votes: np.ndarray, weight: np.ndarray, known: np.ndarray) -> LabelModel:
        """``votes`` (patterns x voters) with their row counts; ``known``: counts of labelled
        rows of each pattern by class, which keep the classes from being swapped."""
        labelled = known.sum(axis=1)
        free = np.maximum(weight - labelled, 0)
        share = known.sum(axis=0) + 1.0
        toxic = (votes == TOXIC).sum(axis=1) > 0
        guess = (known[:, 1] + np.where(toxic, 0.9, 0.02)) / (labelled + 1)
        posterior = np.stack([1 - guess, guess], axis=1)
        self.prior = share / share.sum()
        self.parent = np.full(votes.shape[1], -1)
        for step in range(self.rounds):
            mass = posterior * free[:, None] + known
            if step in (1, 5):
                self.parent = self._tree(votes, mass)
            self.prior = (mass.sum(axis=0) + 1) / (mass.sum() + 2)
            self.tables = self._tables(votes, mass)
            posterior = self.posterior(votes)
        return self

    def _tables(self, votes: np.ndarray, mass: np.ndarray) -> np.ndarray:
        tables = np.full((votes.shape[1], 2, 3, 3), self.smoothing)
        for voter, parent in enumerate(self.parent):
            above = votes[:, parent] if parent >= 0 else np.zeros(len(votes), int)
            for label in (0, 1):
                np.add.at(tables[voter, label], (above, votes[:, voter]), mass[:, label])
        return tables / tables.sum(axis=3, keepdims=True)

    def _tree(self, votes: np.ndarray, mass: np.ndarray) -> np.ndarray:
        """Maximum spanning tree over the information voters share beyond the class."""
        count = votes.shape[1]
        shared = np.zeros((count, count))
        for a in range(count):
            for b in range(a):
                for label in (0, 1):
                    joint = np.full((3, 3), self.smoothing)
                    np.add.at(joint, (votes[:, a], votes[:, b]), mass[:, label])
                    total = joint.sum()
                    apart = joint.sum(axis=1, keepdims=True) * joint.sum(axis=0) / total
                    shared[a, b] += (joint * np.log(joint / apart)).sum()
        shared += shared.T
        parent = np.full(count, -1)
        best, source = shared[0].copy(), np.zeros(count, int)
        best[0] = -1
        for _ in range(count - 1):
            nxt = int(best.argmax())
            parent[nxt] = source[nxt]
            best[nxt] = -1
            closer = (shared[nxt] > best) & (best >= 0)
            best[closer], source[closer] = shared[nxt][closer], nxt
        return parent

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.tile(np.log(self.prior), (len(votes), 1))
        for voter, parent in enumerate(self.parent):
            above = votes[:, parent] if parent >= 0 else np.zeros(len(votes), int)
            for label in (0, 1):
                logs[:, label] += np.log(self.tables[voter, label, above, votes[:, voter]])
        logs -= logs.max(axis=1, keepdims=True)
        out = np.exp(logs)
        return out / out.sum(axis=1, keepdims=True)


def train_linear(
    rows: list[np.ndarray], target: np.ndarray, width: int, penalty: float = 0.3, steps: int = 300
) -> np.ndarray:
    """Logistic regression on sets of feature numbers and soft labels; last weight: intercept."""
    sizes = np.array([len(r) for r in rows])
    column = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    weight, momentum = np.zeros(width + 1), np.zeros(width + 1)
    prior = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    weight[width] = math.log(prior / (1 - prior))
    # Adaptive steps: features are met with very different frequency.
    squares = np.full(width + 1, 1e-8)
    for step in range(1, steps + 1):
        margin = np.bincount(row, weight[column], minlength=len(rows)) + weight[width]
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - target
        slope = np.bincount(column, error[row], minlength=width + 1).astype(float)
        slope[width] = error.sum()
        slope[:width] += penalty * weight[:width]
        momentum = 0.9 * momentum + 0.1 * slope
        squares = 0.99 * squares + 0.01 * slope**2
        weight -= 0.1 * (momentum / (1 - 0.9**step)) / np.sqrt(squares / (1 - 0.99**step))
    return weight


@dataclass
class ToxicityModel:
    """Feature numbers and weights; scores a text by itself, whatever its row says."""

    numbers: dict[str, int]
    weight: np.ndarray
    voters: Voters

    def __post_init__(self):
        self.index = WordIndex(self.voters.toxic.union(self.numbers))
        self.by_name = {f: float(self.weight[n]) for f, n in self.numbers.items()}

    def score(self, text: str | None) -> float:
        found = self.voters.features(text or "", self.index)
        margin = float(self.weight[-1]) + math.fsum(self.by_name.get(f, 0.0) for f in found)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, margin))))


def _labelled_sample(
    docs: DataFrame, labels: DataFrame, text: str, id_column: str, label: str, bound: int
) -> DataFrame:
    """At most ``bound`` labelled rows that may be learnt from: text, toxic (0 or 1)."""
    marks = (
        labels.where(~is_held_out(F.col(f"`{id_column}`")) & F.col(f"`{label}`").isNotNull())
        .groupBy(F.col(f"`{id_column}`").alias("labelled"))
        .agg(F.max(F.col(f"`{label}`").cast("int")).alias("toxic"))
        .where(F.col("labelled").isNotNull())
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(bound)
    )
    texts = docs.select(F.col(f"`{id_column}`").alias("labelled"), F.col(f"`{text}`").alias("text"))
    # The marks are bounded by ``bound``, so the texts need not move to meet them.
    return texts.join(measured(marks), "labelled").select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "toxic"
    )


def _feature_counts(sample: DataFrame) -> DataFrame:
    """Feature, rows with it, toxic rows with it; summed within each batch first."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[toxic > 0].update(text_features(text))
            names = list(seen[0].keys() | seen[1].keys())
            bad = [seen[1][f] for f in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string())]
                + [pa.array([seen[0][f] + b for f, b in zip(names, bad)], pa.int64())]
                + [pa.array(bad, pa.int64())],
                names=["feature", "n", "bad"],
            )

    # Copies of a text would count as so many witnesses of its words.
    distinct = sample.groupBy("text").agg(F.max("toxic").alias("toxic"))
    parts = distinct.mapInArrow(count, "feature string, n long, bad long")
    return parts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    label: str = "toxic",
    sample_rows: int = 20_000,
    vocabulary: int = 6_000,
) -> ToxicityModel:
    """Voters and label model over all documents; classifier on a bounded labelled sample.

    ``sample_rows`` bounds the labelled rows that lexicons are mined from and the classifier is
    trained on (those with the lowest id hash), ``vocabulary`` the features of the classifier.
    Held-out rows' labels are never read. Without any label the fixed lexicons decide alone.
    """
    small_batches(docs.sparkSession)
    sample = _labelled_sample(docs, labels, text, id_column, label, sample_rows)
    totals = sample.groupBy("toxic").count().collect()
    bad_rows = sum(r["count"] for r in totals if r["toxic"] > 0)
    rows = sum(r["count"] for r in totals)
    base = (bad_rows + 1) / (rows + 10)
    counts = _feature_counts(sample).where("n >= 3")
    rate = (F.col("bad") + base * 2) / (F.col("n") + 2)
    lift = F.log(rate / (1 - rate)) - math.log(base / (1 - base))
    ranked = counts.withColumn("lift", lift).withColumn(
        "worth", F.abs("lift") * F.sqrt(F.when(F.col("lift") > 0, F.col("bad")).otherwise(F.lit(1)))
    )
    chosen = ranked.orderBy(F.desc("worth"), "feature").limit(vocabulary).collect()
    # A mined feature needs so many toxic witnesses that chance does not explain them.
    witnesses = max(3, math.ceil(math.log(1e-5) / math.log(base)))
    toxic_only = [
        r["feature"]
        for r in chosen
        if r["bad"] >= witnesses and r["bad"] >= 0.95 * r["n"]
    ]
    mined = {"mined_words": frozenset(f for f in toxic_only if not f[1:2] == ":")}
    for size in PREFIXES:
        mined[f"mined_{size}"] = frozenset(f for f in toxic_only if f.startswith(f"{size}:"))
    voters = Voters({name: found for name, found in mined.items() if found})
    numbers = {r["feature"]: k for k, r in enumerate(chosen)}
    for name in [
        *sorted(voters.all_words), *(name for _, name in LADDER), *voters.pattern_features
    ]:
        numbers.setdefault(name, len(numbers))

    def vote(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index = WordIndex(voters.toxic)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            votes = [voters.votes(voters.features(t, index)) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.string())], names=["votes"])

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index = WordIndex(voters.toxic.union(numbers))
        for batch in batches:
            votes, found = [], []
            for one in batch.column(0).to_pylist():
                features = voters.features(one, index)
                votes.append(voters.votes(features))
                found.append([numbers[f] for f in numbers.keys() & features])
            yield pa.RecordBatch.from_arrays(
                [pa.array(votes, pa.string()), batch.column(1)]
                + [pa.array(found, pa.list_(pa.int32()))],
                names=["votes", "toxic", "found"],
            )

    # One row for each vote pattern that occurs: bounded by the voters, not by the documents.
    patterns = {
        r["votes"]: r["count"]
        for r in docs.select(F.col(f"`{text}`").cast("string").alias("text"))
        .mapInArrow(vote, "votes string")
        .groupBy("votes")
        .count()
        .collect()
    }
    training = sample.mapInArrow(read, "votes string, toxic int, found array<int>").collect()
    for row in training:
        patterns.setdefault(row["votes"], 0)
    place = {v: k for k, v in enumerate(patterns)}
    known = np.zeros((len(place), 2))
    for row in training:
        known[place[row["votes"]], int(row["toxic"] > 0)] += 1
    if not place:
        return ToxicityModel(numbers, np.append(np.zeros(len(numbers)), -3.0), voters)
    votes = np.array([[int(c) for c in v] for v in place])
    model = LabelModel().fit(votes, np.array(list(patterns.values()), float), known)
    posterior = model.posterior(votes)[:, 1]
    target = np.array([posterior[place[r["votes"]]] for r in training])
    found = [np.array(r["found"], np.int64) for r in training]
    # The fixed lexicons and patterns speak for themselves where no labelled row does, and so
    # does a text without any feature.
    for word in sorted(voters.all_words):
        found.append(np.zeros(0, np.int64))
        target = np.append(target, 0.02)
        features = voters.features(word, WordIndex(voters.toxic.union(numbers)))
        found.append(np.array([numbers[f] for f in features & numbers.keys()]))
        target = np.append(target, 0.95)
    for name in voters.pattern_features:
        found.append(np.array([numbers[name]]))
        target = np.append(target, 0.95)
    return ToxicityModel(numbers, train_linear(found, target, len(numbers)), voters)


def score_documents(
    docs: DataFrame,
    model: ToxicityModel,
    text: str = "text",
    id_column: str = "doc_id",
    threshold: float = 0.7,
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``, default all) with held_out, score and predicted.

    NULL and empty texts get the score of a text without any feature. A NULL id is not held
    out. Only the text decides a score, so equal rows score alike. Columns named like a result
    are replaced. One narrow pass.
    """
    results = ["held_out", "score", "predicted"]
    kept = [c for c in (keep or docs.columns) if c not in results]
    (hidden,) = scratch_names(docs, "text")
    source = docs.select(
        F.col(f"`{text}`").cast("string").alias(hidden),
        *[f"`{c}`" for c in kept],
        is_held_out(F.col(f"`{id_column}`")).alias("held_out"),
    )
    schema = T.StructType(
        [source.schema[c] for c in [*kept, "held_out"]]
        + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            scores = np.array([model.score(t) for t in batch.column(0).to_pylist()], float)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(scores)]
                + [pa.array((scores >= threshold).astype(np.int32))],
                names=schema.names,
            )

    return source.mapInArrow(score, schema)


def drop_toxic(
    docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = 0.7
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they are.

    Only the texts go to Python, and one truth value for each comes back.
    """
    import pyarrow as pa

    def clean(texts):
        return pa.array([model.score(t.as_py()) < threshold for t in texts], pa.bool_())

    clean.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return docs.where(F.arrow_udf(clean, T.BooleanType())(F.col(f"`{text}`").cast("string")))
