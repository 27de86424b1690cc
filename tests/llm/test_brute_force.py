"""Each operator against a plain version of its contract, on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from freightmill.llm.byte_bpe import ByteBpe, arrow_texts
from freightmill.llm.common import tokenizer_path
from freightmill.llm.components import components
from freightmill.llm.decontaminate import contaminated_windows
from freightmill.llm.html_text import main_text
from freightmill.llm.jaccard_join import near_duplicate_components
from freightmill.llm.line_dedup import line_classes, within_edits
from freightmill.llm.packing import pack_documents, sum_of_squares
from freightmill.llm.substring_dedup import equal_windows, remove_repeats
from freightmill.llm.toxicity import PATTERNS, LabelModel, Voters, WordIndex, train
from freightmill.llm.url_filter import index_rules, keyword_rule, site_rule

WORDS = [f"w{k}" for k in range(60)]


def some_texts(seed, count):
    """Random texts, and copies of them with a few words or letters changed."""
    draw = random.Random(seed)
    texts = []
    for _ in range(count):
        if texts and draw.random() < 0.5:
            words = draw.choice(texts).split(" ")
            for _ in range(draw.randint(0, 3)):
                words[draw.randrange(len(words))] = draw.choice(WORDS)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(draw.choices(WORDS, k=draw.randint(1, 90))))
    return texts


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


class Sets:
    def __init__(self, size):
        self.parent = list(range(size))

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text):
    words = text.split()
    if len(words) < 5:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def test_jaccard_components(spark):
    texts = some_texts(1, 120)
    sets, groups = [shingles(t) for t in texts], Sets(len(texts))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                groups.join(i, j)
    rows = {r.doc_id: r for r in near_duplicate_components(table(spark, texts)).collect()}
    for i, own in enumerate(sets):
        assert rows[i].n_shingles == len(own)
        assert rows[i].component_id == groups.find(i)


def test_near_copies_beyond_the_hubs(spark):
    """A chain of near copies and many of one text: more than the first rows of a list link."""
    base = [f"b{k}" for k in range(100)]
    texts = []
    for k in range(150):
        words = list(base)
        words[(k * 7) % 100] = f"x{k}"
        texts.append(" ".join(words))
    sets, groups = [shingles(t) for t in texts], Sets(len(texts))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                groups.join(i, j)
    rows = near_duplicate_components(table(spark, texts)).collect()
    assert {r.doc_id: r.component_id for r in rows} == {
        i: groups.find(i) for i in range(len(texts))
    }


def test_large_groups_meet_in_short_lists(spark):
    """Two groups in one short list, of more units than speak for a group, and one link."""
    from freightmill.llm.posting_lists import HUBS, linked_components

    sizes = {1: 3 * HUBS, 2: 2 * HUBS + 5, 3: 1}
    units = [(f"{g}-{k:04d}".encode(), g) for g, size in sizes.items() for k in range(size)]
    # Inside group 2 the first half is linked already, so components are mixed.
    linked = {(f"2-{k:04d}".encode(), f"2-{k + 1:04d}".encode()) for k in range(HUBS)}
    linked |= {(b"1-0150", b"2-0100"), (b"2-0131", b"3-0000"), (b"1-0070", b"1-0171")}
    links = spark.createDataFrame(sorted(linked), "a binary, b binary")
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.join(links, ["a", "b"], "left_semi")

    postings = [(7, g, 10, 0) for g in sizes]
    rows = linked_components(
        spark.createDataFrame(postings, "token long, grp long, n long, pos long"),
        spark.createDataFrame(units, "unit binary, grp long"),
        lambda n_a, n_b, pos_a, pos_b: n_a == n_b,
        "x.n = y.n",
        verify,
    ).collect()
    groups = {u: u for u, _ in units}

    def find(u):
        return u if groups[u] == u else find(groups[u])

    for a, b in linked:
        groups[max(find(a), find(b))] = min(find(a), find(b))
    inside = {u for pair in linked for u in pair}
    found = {bytes(r.node): bytes(r.component) for r in rows}
    assert found == {u: find(u) for u in inside}
    # No pair is verified twice, and all there are is every pair at most.
    assert sum(seen) <= len(units) * (len(units) - 1) // 2


def test_components(spark):
    draw = random.Random(2)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)]
    groups = Sets(300)
    for a, b in pairs:
        groups.join(a, b)
    found = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    linked = {x for p in pairs if p[0] != p[1] for x in p}
    assert {r.node: r.component for r in found} == {x: groups.find(x) for x in linked}


def test_tokens_equal_the_library():
    from tokenizers import Tokenizer

    draw = random.Random(3)
    parts = list("abcstmdlrev'' \n\t\r  .!?09") + [
        "'s", "'re", "'ll", "é", "ß", "漢", "　", "\xa0", "😀", "<|endoftext|>", "²", "Ⅷ", "\x85", "\0",
    ]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(3000)]
    texts += ["", "a" * 3000, "ab" * 2000, " " * 500, "don't you're it's 'tis 'sfoo ''s"]
    library = Tokenizer.from_file(tokenizer_path())
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    import pyarrow as pa

    found = [[] for _ in texts]
    data, bounds = arrow_texts(pa.array(texts, pa.string()))
    for rows, counts, ids in ByteBpe(tokenizer_path()).encode(data, bounds):
        at = 0
        for row, count in zip(rows, counts):
            found[row] += ids[at : at + count].tolist()
            at += count
    assert found == expected


def test_packing_covers_every_document(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    texts = some_texts(4, 80)
    rows = pack_documents(table(spark, texts), capacity=128).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4")
        at = 0
        mine = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.length for r in mine[1:]] == [128] * (len(mine) - 1)
        for number, r in enumerate(mine):
            assert (r.piece, r.start) == (number, at)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // 128) * 1.1 + 1


def test_sum_of_squares_fills_gaps():
    lengths = np.array([60, 40, 70, 30, 100, 50, 50])
    sequence, offset = sum_of_squares(lengths, 100)
    assert len(set(sequence.tolist())) == 4
    for number in set(sequence.tolist()):
        mine = sorted(zip(offset[sequence == number], lengths[sequence == number]))
        assert [o for o, _ in mine] == list(np.cumsum([0] + [n for _, n in mine[:-1]]))


def removed(texts, length):
    seen, out = set(), []
    for text in texts:
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = True
            seen.add(window)
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [4_000, 1])
def test_substring_dedup(spark, monkeypatch, hot):
    from freightmill.llm import substring_dedup

    monkeypatch.setattr(substring_dedup, "HOT_SEGMENTS", hot)
    texts = some_texts(5, 60) + ["é" * 150, "a" * 400, "b" + "a" * 150, "x" * 99]
    rows = remove_repeats(table(spark, texts)).collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert found == dict(enumerate(removed(texts, 100)))


def test_equal_windows():
    draw = random.Random(6)
    text = np.array([draw.choice([1, 2, 3]) for _ in range(400)], np.uint16)
    kinds = equal_windows(text, 6)
    for i in range(395):
        for j in range(i):
            assert (kinds[i] == kinds[j]) == (text[i : i + 6] == text[j : j + 6]).all()


def multiset_similarity(a, b):
    def count(words):
        if len(words) < 5:
            return Counter([" ".join(words)])
        return Counter(" ".join(words[i : i + 5]) for i in range(len(words) - 4))

    a, b = count(a), count(b)
    return sum((a & b).values()) / sum((a | b).values())


def test_decontamination(spark):
    draw = random.Random(7)
    items = [draw.choices(WORDS, k=draw.randint(3, 45)) for _ in range(12)]
    docs = []
    for k in range(80):
        words = draw.choices(WORDS, k=draw.randint(0, 60))
        if k % 2:
            leak = list(draw.choice(items))
            for _ in range(k % 3):
                place = draw.randrange(len(leak))
                leak[place : place + 1] = draw.choice([[], ["new"], ["n1", "n2"]])
            words[5:5] = leak
        docs.append(words)
    expected = {}
    for d, words in enumerate(docs):
        for i, item in enumerate(items):
            starts = range(max(0, len(words) - len(item)) + 1) if words else ()
            best = max((multiset_similarity(words[s : s + len(item)], item) for s in starts), default=0)
            if best >= 0.8:
                expected[d, i] = best
    bench = spark.createDataFrame(
        [(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"
    )
    rows = contaminated_windows(table(spark, [" ".join(w).upper() for w in docs]), bench).collect()
    found = {(r.doc_id, r.item_id): r.similarity for r in rows}
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-12 for k in found)


def test_decontamination_ignores_the_order_of_shingles(spark):
    """Passages with their parts swapped or moved, anywhere in a longer document."""
    draw = random.Random(17)
    items = [[f"i{k}x{j}" for j in range(n)] for k, n in enumerate((50, 60, 45, 90))]
    items.append(draw.choices(WORDS, k=50))
    docs = []
    for k in range(40):
        item = items[k % len(items)]
        at = draw.choice([len(item) // 2, len(item) // 3, 3])
        leak = item[at:] + item[:at]
        if k % 3 == 2:
            leak = leak[:7] + ["new"] + leak[7:]
        if k % 4 == 3:
            leak = leak[::-1]  # all the words, but no shingle
        docs.append(draw.choices(WORDS, k=draw.randint(0, 150)) + leak + draw.choices(WORDS, k=70))
    expected = {}
    for d, words in enumerate(docs):
        for i, item in enumerate(items):
            starts = range(max(0, len(words) - len(item)) + 1)
            best = max(multiset_similarity(words[s : s + len(item)], item) for s in starts)
            if best >= 0.8:
                expected[d, i] = best
    assert len(expected) >= 10
    bench = spark.createDataFrame(
        [(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"
    )
    rows = contaminated_windows(table(spark, [" ".join(w) for w in docs]), bench).collect()
    found = {(r.doc_id, r.item_id): r.similarity for r in rows}
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-12 for k in found)


def test_decontamination_by_a_long_item(spark):
    """An item of 70,000 words, half its shingles repeated, in texts of about its own size."""
    draw = random.Random(23)
    half = [f"t{draw.randrange(9000)}" for _ in range(35_000)]
    item = half + half
    changed = [w if draw.random() < 0.97 else "new" for w in item]
    docs = [item, changed, item[:40_000], draw.choices(half, k=70_000), item[3:] + ["a", "b", "c"]]
    expected = {
        d: multiset_similarity(words, item)
        for d, words in enumerate(docs)
        if multiset_similarity(words, item) >= 0.8
    }
    assert len(expected) == 2
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = contaminated_windows(table(spark, [" ".join(w) for w in docs]), bench).collect()
    found = {r.doc_id: r.similarity for r in rows}
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-12 for k in found)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_within_edits():
    draw = random.Random(8)
    for _ in range(4000):
        a = "".join(draw.choices("ab", k=draw.randint(0, 9)))
        b = "".join(draw.choices("ab", k=draw.randint(0, 9)))
        for edits in (0, 1, 2, 3):
            assert within_edits(a, b, edits) == (distance(a, b) <= edits), (a, b, edits)


def test_line_classes(spark):
    draw = random.Random(9)
    lines = []
    for _ in range(150):
        if lines and draw.random() < 0.6:
            line = list(draw.choice(lines))
            for _ in range(draw.randint(0, 3)):
                at = draw.randrange(len(line))
                line[at : at + 1] = draw.choice([[], ["z"], ["é", "y"]])
            lines.append("".join(line))
        else:
            lines.append("".join(draw.choices("abcdef ", k=draw.randint(21, 60))).strip() + "." * 20)
    groups = Sets(len(lines))
    for i, a in enumerate(lines):
        for j in range(i):
            if a == lines[j] or (min(len(a), len(lines[j])) >= 20 and distance(a, lines[j]) <= 2):
                groups.join(i, j)
    texts = ["\n".join(lines[k : k + 3]) for k in range(0, len(lines), 3)]
    rows = line_classes(table(spark, texts)).collect()
    found = {3 * r.doc_id + r.line: (3 * r.class_id + r.class_line, r.kept) for r in rows}
    assert found == {i: (groups.find(i), groups.find(i) == i) for i in range(len(lines))}


def test_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head>
    <body><nav><ul><li><a href="/a">Menu one</a></li></ul></nav><!-- ad -->
    <div class="ad">Buy this, now, please, it is very good.</div>
    <header><h2>Site name</h2></header>
    <article><h1>Head&amp;line</h1><p><b>First, part<br><p>Second
      part, with   gaps &copy;.</p><blockquote>Quoted.</blockquote></article>
    <div id="comments"><p>Reader, says, this, and, that.</p></div>
    <aside>More</aside><form><p>Sign up</p></form><footer>Foot</footer></body></html>"""
    assert main_text(page) == "Head&line\nFirst, part\nSecond part, with gaps ©.\nQuoted."
    plain = "<div><p>" + "Long text, with commas, here. " * 9 + "</p><p>And more.</p></div>"
    menu = "<div class='menu'><a href='/'>x</a></div>"
    assert main_text(f"<body>{menu}{plain}</body>").endswith("And more.")
    assert "x\n" not in main_text(f"<body>{menu}{plain}</body>")


ARTICLE = "".join(f"<p>Part {k} of the article, with commas, and more.</p>" for k in range(8))


@pytest.mark.parametrize(
    "opening, closing",
    [
        ('<div data-hidden="false">', "</div>"),
        ('<div title="a hidden gem" data-role="banner">', "</div>"),
        ("<div aria-label='the hidden cost' data-note='role=menu style=display:none'>", "</div>"),
        ('<div title="x > y" data-class="sidebar">', "</div>"),
        ('<div class="container has-sidebar">', "</div>"),
        ('<div class="no-sidebar"><div class="with-menu">', "</div></div>"),
        ('<form id="aspnetForm" action="/"><input type="hidden" value="1">', "</form>"),
        ('<form><div class="no-sidebar">', "</div></form>"),
    ],
)
def test_main_text_survives_misleading_markup(opening, closing):
    text = main_text(
        "<body><div class='menu'><a href='/'>Menu</a></div>"
        f"{opening}<h1>Title</h1>{ARTICLE}<div class='comments'><p>Reader, says.</p></div>{closing}"
        "<div><p>All rights reserved</p></div></body>"
    )
    lines = text.split("\n")
    assert [x for x in lines if x.startswith("Part")] == [
        f"Part {k} of the article, with commas, and more." for k in range(8)
    ]
    assert "Title" in lines and "Menu" not in lines and "Reader, says." not in lines


def test_main_text_keeps_out_what_is_hidden_or_beside():
    page = "<body><article><p>Short, but it is the article, of this page.</p></article>{}</body>"
    only = "Short, but it is the article, of this page."
    for beside in (
        f"<div id='comments'>{ARTICLE}</div>", f"<div HIDDEN>{ARTICLE}</div>",
        f"<div class=x hidden=''>{ARTICLE}</div>", f"<div style='display: none'>{ARTICLE}</div>",
        f"<div aria-hidden=true>{ARTICLE}</div>", f"<div role=navigation>{ARTICLE}</div>",
        f"<form>{ARTICLE}</form>",
    ):
        assert main_text(page.format(beside)) == only
    # Without any other text a form's is the page's.
    assert main_text("<form class='popup'><p>Tiny</p></form>") == "Tiny"


def test_rules_are_indexed_by_their_rarest_token():
    rules = [site_rule("example.com", "/en/", "block"), keyword_rule("cheap pills")]
    index = index_rules(rules, {"com": 9, "example": 5, "en": 2, "cheap": 1, "pills": 3})
    assert {t: [r.name for r in under] for t, under in index.items()} == {
        "en": ["example.com/en/"], "cheap": [None],
    }
    assert re.search(rules[0].pattern, "www.example.com/en/x")
    assert not re.search(rules[0].pattern, "badexample.com/en/x")


def test_label_model_finds_good_voters():
    draw = np.random.default_rng(0)
    truth = draw.random(4000) < 0.2
    rates = [(0.9, 0.02), (0.9, 0.02), (0.7, 0.05), (0.5, 0.5)]
    votes = np.stack([draw.random(4000) < np.where(truth, a, b) for a, b in rates], axis=1) * 1
    votes = np.concatenate([votes, votes[:, :1]], axis=1)  # a copy of the first voter
    patterns, back, weight = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    known = np.zeros((len(patterns), 2))
    for k in range(200):
        known[back[k], int(truth[k])] += 1
    model = LabelModel().fit(patterns, weight.astype(float), known)
    assert model.parent[4] == 0 or model.parent[0] == 4
    guess = model.posterior(patterns)[back, 1] > 0.5
    assert (guess == truth).mean() > 0.95


def test_patterns_vote_on_every_text():
    """Patterns fit as the plain search says, and a text that one fits is not spotless."""
    draw = random.Random(18)
    voters = Voters()
    index = WordIndex(voters.toxic)
    parts = (
        "you u ye're are is an so, go should must will hope and die rot burn hang kill yourself "
        "KILL YOURSELF yoursel\u017f killyourself idiots a_loser scumbag \u0130diot tra\u017fh d\u0131e "
        "GET OUT NOW ALL OF YOU !! !!! ! YOU YOU'RE \n"
    ).split(" ")
    texts = [" ".join(draw.choices(parts, k=draw.randint(1, 9))) for _ in range(20_000)]
    fits = Counter()
    for text in texts:
        features = voters.features(text, index)
        plain = {
            k for k, p in PATTERNS.items() if re.search(p, text, re.I if k != "shouted" else 0)
        }
        fits.update(plain)
        assert {f[1:] for f in features if f.startswith("/")} == plain, text
        vote = dict(zip(voters.names, voters.votes(features)))
        assert {k for k in PATTERNS if vote[k] == "1"} == plain
        assert (vote["spotless"] == "2") == ("#1" not in features and not plain)
    assert len(fits) == len(PATTERNS)


def test_a_wish_alone_is_toxic(spark):
    """Labelled rows whose only sign is a pattern, of words that clean rows hold too."""
    wish, calm = "i hope you die soon friend number", "you hope the soon i friend plants die number"
    texts = [f"{wish if k % 3 == 0 else calm} n{k}" for k in range(150)]
    labels = spark.createDataFrame(
        [(k, int(k % 3 == 0)) for k in range(150)], "doc_id long, toxic int"
    )
    model = train(table(spark, texts), labels)
    assert model.score(wish) >= 0.7 > model.score(calm)
    unlabelled = train(table(spark, texts), labels.where("false"))
    assert unlabelled.score("now go die") > unlabelled.score("now go home")
