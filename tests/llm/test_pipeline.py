"""The pipeline on the smallest tables with planted cases, each stage against a plain version."""

import string
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from freightmill.llm.common import shared_folder, tokenizer_path
from freightmill.llm.toxicity import train

TABLES = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: Names that stages use themselves.
EXTRA = ("_digest", "_winner", "_text", "_key", "_shard", "keep_id", "score", "sequence_id", "w")
FIRST = 10_000_000


def split(text):
    lowered = (text or "").translate(LOWER)
    for gap in "\t\n\v\f\r":
        lowered = lowered.replace(gap, " ")
    return [w for w in lowered.split(" ") if w]


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or [tuple(words)] * bool(words)


def planted(passage):
    story = [f"s{k}" for k in range(60)]
    near = story[:30] + ["other"] + story[31:]
    far = story[:40] + [f"f{k}" for k in range(20)]
    long = " ".join(f"n{k * k % 7919}" for k in range(30_000))
    rows = [
        None, "", " \t\n ", "tiny", "TINY", " ".join(story), " ".join(story).upper(),
        " ".join(near), " ".join(far), " ".join(near), long, long + " tail",
        "before it " + passage + " behind it", passage.upper(), "é\U0001f600 " * 9,
    ]
    return list(enumerate(rows, FIRST)) + [(FIRST + 4, "TINY"), (None, "no id at all here")]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each, the benchmark's texts, and the model."""
    folder, shared = (tmp_path_factory.mktemp(n) for n in ("tables", "shared"))
    items = spark.read.parquet(f"{TABLES}/benchmark.parquet")
    texts = [r.text for r in items.select("text").collect()]
    passage = max(texts, key=lambda t: len(split(t)))
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    more = spark.createDataFrame(planted(passage), "doc_id long, text string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    docs = docs.withColumns({name: F.lit("own") for name in EXTRA})
    docs.write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    spark.read.parquet(f"{TABLES}/labels.parquet").write.parquet(f"{folder}/labels.parquet")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(corpus_pipeline, "shared_folder", lambda spark: str(shared))
        last = corpus_pipeline.run(spark, str(folder)).collect()
    (made,) = shared.iterdir()
    tables = [spark.read.parquet(f"{folder}/documents.parquet")]
    for number, (name, _) in enumerate(corpus_pipeline.STAGES[:-1]):
        tables.append(spark.read.parquet(f"{made}/{number}-{name}"))
        assert tables[-1].columns == docs.columns
        assert tables[-1].where("w != 'own' OR keep_id != 'own' OR _winner != 'own'").count() == 0
    rows = [[(r.doc_id, r.text) for r in t.select("doc_id", "text").collect()] for t in tables]
    model = train(tables[0], spark.read.parquet(f"{folder}/labels.parquet"))
    return rows, last, texts, model


def test_toxicity_stage(stages):
    (before, after, *_), _, _, model = stages
    assert Counter(after) == Counter(r for r in before if model.score(r[1]) < 0.7)
    assert {FIRST + k for k in range(15)} <= {i for i, _ in after}


def test_exact_stage(stages):
    (_, before, after, *_), _, _, _ = stages
    winners = {}
    for i, text in before:
        same = (text or "").translate(LOWER)
        winners[same] = max(winners.get(same, -1), -1 if i is None else i)
    kept = [(-1 if i is None else i, (t or "").translate(LOWER)) for i, t in after]
    assert sorted(kept) == sorted((i, t) for t, i in winners.items())


def test_near_stage(stages):
    (_, _, before, after, *_), _, _, _ = stages
    sets = [set(shingles(split(t))) for _, t in before]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    groups = {}
    for k, row in enumerate(before):
        groups.setdefault(find(k), []).append(row)
    kept = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    assert Counter(after) == Counter(kept)
    assert len(after) < len(before)


def test_decontamination_stage(stages):
    (*_, before, after), _, texts, _ = stages
    items = [split(t) for t in texts if split(t)]
    counted = [(len(w), set(w), Counter(shingles(w))) for w in items]

    def leaks(text):
        words = split(text)
        present = set(words)
        for size, own, marks in counted:
            # A shingle that is missing needs a missing word, so this only saves time.
            if not words or len(own & present) < len(own) - (sum(marks.values()) * 0.2 + 1):
                continue
            for s in range(max(0, len(words) - size) + 1):
                mine = Counter(shingles(words[s : s + size]))
                common = sum((mine & marks).values())
                if common >= 0.8 * sum((mine | marks).values()) - 1e-9:
                    return True
        return False

    kept = [r for r in before if not leaks(r[1])]
    assert Counter(after) == Counter(kept)
    assert len(kept) < len(before)


def test_packing_stage(stages):
    (*_, before), last, _, _ = stages
    library = Tokenizer.from_file(tokenizer_path())
    lengths = Counter()
    for i, text in before:
        lengths[i] += len(library.encode(text or "", add_special_tokens=False).ids) + 1
    packed, places = Counter(), {}
    for r in last:
        packed[r.doc_id] += r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert packed == lengths
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(places) <= 1.1 * -(-sum(lengths.values()) // 1024) + 1


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{TABLES}/{name}.parquet").where("false").write.parquet(
            f"{tmp_path}/{name}.parquet"
        )
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


class Session:
    """As much of a session as the folder depends on."""

    def __init__(self, master, **settings):
        self.sparkContext, self.master, self.settings = self, master, settings

    def getConf(self):
        return {k.replace("_", "."): v for k, v in self.settings.items()}


def test_a_cluster_needs_a_shared_folder():
    for master in ("spark://host:7077", "local-cluster[3,2,1024]", "yarn"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Session(master))
        assert shared_folder(Session(master, spark_checkpoint_dir="s3a://x/y")) == "s3a://x/y"
    assert shared_folder(Session("local[4]")) != shared_folder(Session("local[4]"))
