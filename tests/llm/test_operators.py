"""Each operator against a brute-force version on small tables with nulls, empty
texts, repeated rows, clashing extra columns, and on an empty table."""

import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from cohortlake.llm import bpe, decontaminate, induced, licenses, pii, quality, quotes, rlz, rules, simhash, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, block int, copy string, words int, pii int"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    word = lambda: r.choice("the of and tion ing er on that é ß".split()) + r.choice(["", "er", "ly", "s"])
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, out = prose(40), []
    for i in range(40):
        t = prose(r.randrange(0, 120))
        if i % 4 == 0:
            t += "\n" + shared[r.randrange(3):] + " " + prose(9)
        if i % 5 == 0 and i:
            t = out[i - 5][1] + (" more" if i % 2 else "")
        out.append((i, t))
    out += [(100, None), (101, ""), (102, " \n\t "), (None, shared), (103, shared), (103, shared), (104, "ab " * 400),
            (105, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."),
            (106, "call +1 (017) 555-7713 card 4539578763621486 not 4539578763621487 a.b@c.example.com 2024-02-29")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src", 1, "x", 2, 3) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *names):
    return Counter((r["doc_id"], *[r[n] if not isinstance(r[n], (bytes, bytearray)) else bytes(r[n]) for n in names])
                   for r in df.collect())


def removed(rows, split, join, window):
    order = sorted((float("inf") if i is None else i, i, t) for i, t in rows if t is not None)
    order += [(float("inf") if i is None else i, i, "") for i, t in rows if t is None]
    seen, out = {}, Counter()
    for rank, i, t in sorted(order, key=lambda x: x[0]):
        s = split(t)
        gone = [False] * len(s)
        for j in range(len(s) - window + 1):
            if seen.setdefault(tuple(s[j:j + window]), rank) < rank:
                gone[j:j + window] = [True] * window
        out[(i, len(s), sum(gone), join([x for x, g in zip(s, gone) if not g]))] += 1
    return out


def test_rlz(docs, empty, rows):
    got = by_id(rlz.remove_repeated_passages(docs), "n_words", "n_removed", "kept")
    assert got == removed(rows, str.split, " ".join, 13)
    assert rlz.remove_repeated_passages(empty).count() == 0


def test_suffix_dedup(docs, empty, rows):
    got = by_id(suffix_dedup.remove_repeated_bytes(docs), "n_bytes", "n_removed", "kept")
    assert got == removed(rows, lambda t: list(t.encode()), bytes, 50)
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0


@pytest.mark.parametrize("memory,step", [(64 << 20, 1 << 17), (100, 5)])
def test_induced_sorting(monkeypatch, memory, step):
    monkeypatch.setattr(induced, "MEMORY", memory)
    monkeypatch.setattr(induced, "STEP", step)
    r = random.Random(2)
    for _ in range(60):
        alphabet, limit = r.choice([1, 2, 3, 26]), r.choice([3, 10, 20])
        strings = [bytes(97 + r.randrange(alphabet) for _ in range(r.randrange(1, 40))) for _ in range(r.randrange(1, 15))]
        place, lcp = induced.suffixes(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), limit)
        text = [x for s in strings for x in [*(c + 2 for c in s), 1]] + [0]
        heads = [text[i:i + limit] for i in place]
        assert sorted(place) == list(range(len(text) - 1)) and heads == sorted(heads)
        for a, b, n in zip(heads, heads[1:], lcp[1:]):
            assert n == next((k for k in range(limit) if a[k:k + 1] != b[k:k + 1] or k >= min(len(a), len(b))), limit)


def test_simhash(docs, empty, rows):
    import xxhash
    prints = []
    for i, t in rows:
        w = (t or "").lower().split()
        h = [xxhash.xxh64_intdigest(" ".join(w[k:k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    for _ in rows:
        group = [min(group[b] for b in range(len(rows)) if (prints[a] ^ prints[b]).bit_count() <= 4) for a in range(len(rows))]
    least = {g: min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in group}
    expected = Counter((i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, group))
    assert by_id(simhash.near_duplicates(docs), "fingerprint", "component_id") == expected
    assert simhash.near_duplicates(empty).count() == 0


def test_bpe(docs, empty, rows):
    import public_tokenizers as P
    import tiktoken
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    whole = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter((i, len(n := whole.encode_ordinary(t or "")), np.array(n, "<u4").tobytes(), (t or "").encode()) for i, t in rows)
    assert by_id(bpe.encode(docs, bpe.read_ranks(path), P.PATTERN), "n_tokens", "ids", "decoded") == expected
    assert bpe.encode(empty, bpe.read_ranks(path), P.PATTERN).count() == 0
    for word in (b"a" * 500, b"ab" * 90, "日本語".encode() * 30):
        assert bpe.merge_long(word, ranks) == whole._encode_single_piece(word)


def test_bpe_merges_many_words_at_once(monkeypatch):
    import public_tokenizers as P
    import pyarrow as pa
    import tiktoken
    ranks = {base64.b64decode(a): b for a, b in bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))}
    whole = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    merges, r = bpe.Merges(ranks), random.Random(3)
    words = [bytes(r.choice(b"aabeinst \xc3\xa9\xff") for _ in range(r.choice([1, 2, 7, 8, 9, 16, 17, 33, 64, 65, 90])))
             for _ in range(3000)]
    assert merges.encode(words) == [np.array(whole._encode_single_piece(w), "<u4").tobytes() for w in words]
    assert merges.encode([]) == []
    texts = [None, "", "a\x1cb \u3000 c", "é" * 70, *("".join(r.choice("abé 1\n.") for _ in range(60)) for _ in range(50))]
    monkeypatch.setattr(bpe, "REMEMBERED", 9)
    monkeypatch.setattr(bpe, "STEP", 100)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    got = pa.Table.from_batches(bpe.coder(merges, P.PATTERN)([batch, batch.slice(0, 0)])).to_pydict()
    assert got["ids"] == [np.array(whole.encode_ordinary(t or ""), "<u4").tobytes() for t in texts]
    assert got["decoded"] == [(t or "").encode() for t in texts] and got["doc_id"] == list(range(len(texts)))


def test_decontamination(spark, docs, empty, rows):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    items = [("b", rows[4][1]), ("a", "MIT license"), ("c", None), ("d", ""), (None, "call"), ("e", rows[9][1])]
    expected = Counter()
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            n = min(10, len(v))
            for k in range(len(v) - n + 1 if n else 0):
                for j in range(len(w) - n + 1):
                    if w[j:j + n] == v[k:k + n]:
                        hit |= set(range(j, j + n))
                        found |= {item} - {None}
        expected[(i, len(w), len(hit), tuple(sorted(found)), bool(hit))] += 1
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.contamination(docs, bench).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got) == expected
    assert decontaminate.contamination(empty, bench).count() == 0
    assert not any(r.n_hit for r in decontaminate.contamination(docs, bench.limit(0)).collect())


def test_licenses(docs, empty):
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (got[105].n_base, got[105].first_word, got[105].last_word) == (2, 3, 8)  # "mit" and "apache"
    assert got[105].base_labels == "apache,mit" and "apache-2.0" in got[105].labels
    assert got[100].n_words == 0 and got[100].labels == "" and got[100].first_word is None
    assert licenses.scan(empty).count() == 0


def test_rules(spark, docs, empty, rows):
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    got = rules.apply_rules(docs, labels)
    expected = Counter()
    for i, t in rows:
        t = t or ""
        w = t.split()
        c = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        twice = {k + d for k in range(len(w) - 2) if c[tuple(w[k:k + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if x.split()]
        expected[(i, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(twice),
                  len(w) < 50 or 100 * len(twice) > 50 * len(w))] += 1
    assert by_id(got, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == expected
    assert rules.apply_rules(empty, labels).count() == 0
    assert rules.apply_rules(docs, labels.limit(0)).where("rule > 0").count() == 0


def test_rules_learn_a_threshold(spark):
    text = lambda i: " ".join(f"w{i}x{k}" + ("###" if i % 2 else "") for k in range(60))
    docs = spark.createDataFrame([(i, text(i)) for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    assert {(r.doc_id % 2, r.kept) for r in rules.apply_rules(docs, labels).collect()} == {(0, True), (1, False)}


def test_quality(spark, docs, empty):
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(60)) + (" idiot" if i % 4 == 0 else "")
    own = spark.createDataFrame([(i, text(i), f"s{i % 3}", "en") for i in range(200)], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    assert {(r.doc_id % 4 == 0, r.kept) for r in quality.classify(own, labels).collect()} == {(True, False), (False, True)}
    assert quality.classify(docs, labels.limit(0)).where("kept").count() == docs.count()
    assert quality.classify(empty, labels).count() == 0


def test_quality_learns_from_few_documents(spark):
    text = lambda i, tail: " ".join(f"w{i}x{k}" for k in range(60)) + tail
    own = [(i, text(i, " idiot" if i % 8 == 0 else ""), "en") for i in range(400)]
    own += [(i, text(i, " bomenteco" if i % 10 == 0 else ""), "es") for i in range(1000, 1120)]
    labels = [(i, 1, int(i % 8 == 0)) for i in range(320)] + [(i, 1, int(i % 10 == 0)) for i in range(1000, 1080)]
    got = quality.classify(spark.createDataFrame([(*x, "s") for x in own], "doc_id long, text string, lang string, source string"),
                           spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    bad = {i for i, t, _ in own if t.endswith(("idiot", "bomenteco"))}
    assert {r.doc_id for r in got.where("NOT kept").collect()} == bad


def test_quality_needs_no_quality_label_for_toxicity(spark):
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(60)) + (" idiot" if i % 4 == 0 else "")
    own = spark.createDataFrame([(i, text(i), "s", "en") for i in range(200)], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, None, int(i % 4 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    assert {(r.doc_id % 4 == 0, r.kept) for r in quality.classify(own, labels).collect()} == {(True, False), (False, True)}


def test_pii(docs, empty, rows):
    feistel = pii.Feistel(b"k")
    for kind, size in (("a", 1), ("a", 2), ("b", 10), ("c", 1000)):
        image = [feistel.permute(kind, x, size) for x in range(size)]
        assert sorted(image) == list(range(size))
        assert [feistel.permute(kind, x, size, back=True) for x in image] == list(range(size))
    text = rows[-1][1]
    new, counts = pii.replace(feistel, text)
    assert counts == {"phone": 1, "card": 1, "email": 1, "date": 1} and "4539578763621487" in new
    assert re.sub("[a-z]", "a", re.sub(r"\d", "0", new)) == re.sub("[a-z]", "a", re.sub(r"\d", "0", text))
    assert pii.replace(feistel, new, back=True)[0] == text and "555-7713" not in new
    got = {r.doc_id: r for r in pii.pseudonymize(docs).collect()}
    assert got[100].text is None and got[101].text == "" and got[0].text == rows[0][1] and got[106].text != text
    assert pii.pseudonymize(empty).count() == 0 and pii.pseudonymize(docs).count() == len(rows)


def test_quotes(spark):
    schema = "conv_id long, turn long, role string, text string, hash string"
    data = [(1, 0, "u", "Hello there.\nHow are you?", ""), (1, 1, "a", "> How are you?\nFine!", ""),
            (1, 2, "u", ">> how are YOU\n> Fine!\nGood.", ""), (1, 3, "a", None, ""), (2, 0, "u", "> Hello there.\nnew", ""),
            (2, 0, "u", "> Hello there.\nnew", ""), (2, 1, "u", "> never said", ""), (None, 0, "u", "> Fine!", ""), (3, 0, "u", "", "")]
    got = quotes.link_quotations(spark.createDataFrame(data, schema)).collect()
    assert len(got) == len(data)
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[1, 2].body == "Good." and (by[1, 2].reply_conv, by[1, 2].reply_turn, by[1, 2].depth) == (1, 1, 2)
    assert (by[2, 0].thread_conv, by[2, 0].thread_turn) == (1, 0) and by[2, 1].n_linked == 0 and by[1, 3].body is None
    assert quotes.link_quotations(spark.createDataFrame([], schema)).count() == 0


def test_quotes_of_some_lines_and_of_other_conversations(spark):
    said = "One fish.\nTwo fish!\n\nRed fish?\nBlue fish.\nTwo fish!"
    data = [(1, 0, "u", said), (1, 1, "a", "> two fish\n> Red fish\nyes"), (1, 2, "u", "> Red fish?\n>\n> Blue fish.\n> Two fish!"),
            (1, 3, "a", "> One fish.\n> Red fish?\nno such run"), (1, 4, "u", "> Two fish!\n> Red fish?\n> Two fish!"),
            (1, 5, "a", "> Two fish!\n> Green fish.\nquotes a later one"), (1, 6, "u", "Two fish!\nGreen fish."),
            (2, 0, "u", "> late\n> words\nnew"), (3, 0, "u", "so\nlate\nwords"), (4, 0, "u", "late\nwords\nagain"),
            (5, 0, "u", "> here a\n> here b\nthere a\nthere b\nx"), (6, 0, "u", "> there a\n> there b\nhere a\nhere b\ny"),
            (7, 0, "u", "> y\nend"), (8, 0, "u", "> alone\nalone")]
    got = quotes.link_quotations(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).collect()
    to = {(r.conv_id, r.turn): [(q.conv_id, q.turn) for q in r.quoted] for r in got}
    thread = {(r.conv_id, r.turn): (r.thread_conv, r.thread_turn, r.depth) for r in got}
    assert len(got) == len(data)
    assert to[1, 1] == to[1, 2] == [(1, 0)] and not to[1, 3] and not to[1, 4] and not to[1, 5]
    assert to[2, 0] == [(3, 0)] and thread[2, 0] == (3, 0, 1) and not to[8, 0]
    assert to[5, 0] == [(6, 0)] and to[6, 0] == [(5, 0)] and to[7, 0] == [(6, 0)]  # a circle
    assert thread[5, 0] == (5, 0, 0) and thread[6, 0] == (5, 0, 1) and thread[7, 0] == (5, 0, 2)


def test_pipeline(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert 0 < len(ids) == out.count() <= docs.count()
    assert hashlib.sha256(bytes(out.first().decoded)).digest()
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_near_dedup_keeps_every_text_that_is_no_copy(spark):
    import corpus_pipeline
    text = lambda name: " ".join(f"{name}{k}" for k in range(80))
    first, own, other, third = text("a"), text("b"), text("c"), text("d")
    data = [(1, first, "en"), (7, first, "en"), (7, own, "en"), (9, other, "en"), (9, third, "fr"), (9, third, "en"), (9, third, "fr"),
            (8, other, "en"), (None, own, "en"), (None, own, "en")]
    kept = {(1, first), (7, own), (8, other), (9, third), (None, own)}
    answers = set()
    for order in (data, data[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string").repartition(5)
        got = corpus_pipeline.near_dedup(spark, docs, None).collect()
        assert {(r.doc_id, r.text) for r in got} == kept and len(got) == 6
        answers.add(tuple(sorted((r.doc_id or 0, r.text, r.lang) for r in got)))
    assert len(answers) == 1
