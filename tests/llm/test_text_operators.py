"""Each operator against a plain version on texts with nulls, blanks, repeats, ties and long words."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastemill.llm import byte_bpe, decontaminate, line_crf, pii, simhash, super_kmers, token_counts
from tastemill.llm.words import ALNUM, Words, text_buffer

tokenizers_files = pytest.importorskip("public_tokenizers")

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, ranges string, found string"


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def corpus():
    rnd = random.Random(5)
    vocabulary = ["alpha", "Beta", "gämma", "d€lta", "x", "I'm", "42", "a-b", "%%%", "Zoë"]
    line = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage = line(40)
    texts = [None, "", "   \n\t ", "one", "one two", passage, passage, line(30) + "\n" + passage + " " + line(20), passage.upper(), "w" * 20_000, line(5_000),
             "same line here\nsame line here\n\nother\r\nsame line here", "é" * 300, line(13), "\x1c\x0b a\x0cb", " ".join(["go"] * 60)]
    texts += [line(rnd.randrange(1, 60)) for _ in range(40)]
    words = texts[-1].split()
    texts += [" ".join(words[:-1] + ["changed"]), texts[-1], None]
    return list(enumerate(texts)) + [(3, "one")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, "clash", "clash", "clash") for i, t in corpus()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_words_match_the_patterns():
    texts = [t for _, t in corpus()]
    for kinds, pattern in ((None, SPACED), (ALNUM, ALNUM_WORD)):
        texts = [t if kinds is None or t is None else lower(t) for t in texts]
        buf, offsets = text_buffer(pa.array(texts, pa.string()))
        words = Words(buf, offsets) if kinds is None else Words(buf, offsets, kinds)
        data = buf.tobytes()
        for k, text in enumerate(texts):
            mine = [data[words.starts[i]:words.ends[i]].decode() for i in range(words.first[k], words.first[k + 1])]
            assert mine == pattern.findall(text or "")


def test_super_kmers(docs, empty):
    rows = corpus()
    seen = {}
    for doc, text in rows:
        words = SPACED.findall(text or "")
        for k in range(len(words) - 12):
            key = tuple(words[k:k + 13])
            seen[key] = min(doc, seen.get(key, doc))
    expected = []
    for doc, text in rows:
        words = SPACED.findall(text or "")
        gone = {p for k in range(len(words) - 12) if seen[tuple(words[k:k + 13])] < doc for p in range(k, k + 13)}
        kept = " ".join(w for p, w in enumerate(words) if p not in gone)
        expected.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = super_kmers.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert collected(found) == collections.Counter(expected)
    assert any(e[2] for e in expected)
    assert super_kmers.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("heavy", [1 << 30, 20_000])
def test_super_kmers_of_log_lines(spark, monkeypatch, heavy):
    """A phrase every few words with other words around it: one minimiser holds most windows, and is dealt out."""
    monkeypatch.setattr(super_kmers, "HEAVY_BYTES", heavy)
    monkeypatch.setattr(super_kmers, "BUCKET_BYTES", 1000)
    rnd = random.Random(3)
    line = lambda: "took ms at host " + " ".join(f"v{rnd.randrange(10**6)}" for _ in range(4))
    rows = [(k, " ".join(line() for _ in range(30))) for k in range(40)]
    rows += [(k, rows[k - 100][1] + " " + line()) for k in range(110, 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    size = sum(len(t) for _, t in rows)
    found = super_kmers.heavy_buckets(docs, size // 1000, size, 13)
    assert bool(found) == (heavy < size)
    seen, expected = {}, {}
    for doc, text in rows:
        words = text.split()
        for k in range(len(words) - 12):
            seen.setdefault(tuple(words[k:k + 13]), doc)
        expected[doc] = len({p for k in range(len(words) - 12) if seen[tuple(words[k:k + 13])] < doc for p in range(k, k + 13)})
    assert {r.doc_id: r.n_removed for r in super_kmers.remove_repeats(docs).collect()} == expected and sum(expected.values()) > 1000


def test_super_kmers_null_id(spark):
    text = " ".join(map(str, range(20)))
    found = super_kmers.remove_repeats(spark.createDataFrame([(None, text), (2, text), (1, text)], "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in found.collect()} == {None: 0, 1: 0, 2: 20}


def test_super_kmers_equal_hashes(monkeypatch):
    """Windows whose hashes meet by chance stay apart."""
    monkeypatch.setattr(super_kmers, "spans_hash", lambda values, starts, ends, table=None: np.zeros(len(starts), np.uint64))
    words = Words(*text_buffer(pa.array(["a b c d", "b c d e", "a b c"], pa.large_binary())))
    ids = super_kmers._window_ids(words, np.array([0, 1, 4, 5, 8]), 3)
    assert ids[0] == ids[4] and ids[1] == ids[2] and len(set(ids.tolist())) == 3


def bits(a, b):
    return bin((a ^ b) & (2**64 - 1)).count("1")


def brute_components(fps):
    parent = {d: d for d, _ in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, f in fps:
        for e, g in fps:
            if bits(f, g) <= 3:
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return {d: root(d) for d, _ in fps}


def plain_fingerprint(text):
    import xxhash

    words = SPACED.findall(lower(text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, empty):
    expected = {d: plain_fingerprint(t) for d, t in corpus()}
    roots = brute_components(list(expected.items()))
    for row in simhash.near_duplicates(docs).collect():
        assert row.fp & (2**64 - 1) == expected[row.doc_id] and row.component_id == roots[row.doc_id]
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(roots.values()))


@pytest.mark.parametrize("rows", [4096, 16])
def test_fingerprint_links_lose_none(spark, monkeypatch, rows):
    """Dense groups too, and buckets that are dealt out in blocks."""
    monkeypatch.setattr(simhash, "BUCKET_ROWS", rows)
    rng = random.Random(2)
    values = {0}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(40):
            value = centre
            for b in rng.sample(range(64), rng.randrange(0, 5)):
                value ^= 1 << b
            values.add(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    from tastemill.llm.components import components

    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"))
    for a, b in links.collect():
        assert a in signed and b in signed
    roots = {r.node: r.root for r in components(links).collect()}
    expected = brute_components([(v, v) for v in sorted(signed)])
    assert all(roots.get(v, v) == expected[v] for v in signed)


@pytest.mark.parametrize("block", [16 << 20, 300])
def test_decontaminate(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    long_text = next(t for i, t in corpus() if i == 5)
    items = [(1, long_text[:150]), (2, "One two"), (10, None), (11, ""), (1, long_text[60:]), (7, "GO " * 30), (8, "not there at all whatever the text may be in here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for item, text in items:
        words = ALNUM_WORD.findall(lower(text or ""))
        n = min(10, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k:k + n]), set()).add(str(item))
    expected, clean = [], []
    for doc, text in corpus():
        words, hit, names = ALNUM_WORD.findall(lower(text or "")), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if found := windows.get(tuple(words[k:k + n])):
                    names |= found
                    hit.update(range(k, k + n))
        expected.append((doc, len(words), len(hit), len(names), tuple(sorted(names))))
        if not hit:
            clean.append(doc)
    found = decontaminate.find_matches(docs, benchmark).select("doc_id", "n_words", "n_hit", "n_items", "items")
    assert collections.Counter((*r[:4], tuple(r[4])) for r in found.collect()) == collections.Counter(expected)
    kept = decontaminate.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(clean)
    assert decontaminate.find_matches(empty, benchmark).count() == 0
    assert decontaminate.find_matches(docs, benchmark.where("false")).where("n_hit > 0").count() == 0


def test_longest_match():
    index = decontaminate.build_index([("i", " ".join(f"w{k}" for k in range(30)))])
    text = "x " + " ".join(f"W{k}" for k in range(4, 27)) + " y"
    n_words, hits, items, matches = decontaminate._scan(index, pa.record_batch({"text": [text]}))
    assert (n_words, hits, items) == ([25], [[(1, 23)]], [["i"]]) and matches == [[{"item": "i", "start": 1, "length": 23}]]


def test_longest_matches_are_those_of_all_pairs():
    rnd = random.Random(7)
    draw = lambda n, letters: [rnd.choice(letters) for _ in range(n)]
    items = [(f"i{k}", draw(rnd.randrange(8, 60), "abc"[:rnd.randrange(1, 4)])) for k in range(25)]
    items.append(("copy", items[3][1]))
    index = decontaminate.build_index([(n, " ".join(w)) for n, w in items])
    texts = [sum((rnd.choice(items)[1][rnd.randrange(5):] + draw(rnd.randrange(3), "abcz") for _ in range(4)), []) for _ in range(30)] + [["a"] * 400, []]
    n_words, hits, names, matches = decontaminate._scan(index, pa.record_batch({"text": [" ".join(t) for t in texts]}))
    for text, runs, found, mine in zip(texts, hits, names, matches):
        at, whole, covered, seen = {}, set(), set(), set()
        for name, words in items:
            n = min(10, len(words))
            for p in range(len(text) - n + 1):
                for q in range(len(words) - n + 1):
                    m = 0
                    while p + m < len(text) and q + m < len(words) and text[p + m] == words[q + m]:
                        m += 1
                    if m >= n:
                        covered.update(range(p, p + n))
                        seen.add(name)
                        if n < 10:
                            whole.add((p, n))  # a short item is one window, found or not
                        else:
                            at[p] = max(at.get(p, 0), m)
        assert {k for s, n in runs for k in range(s, s + n)} == covered and found == sorted(seen)
        assert {(m["start"], m["length"]) for m in mine if m["length"] < 10} == whole
        starts = {m["start"]: m["length"] for m in mine if m["length"] >= 10}
        assert starts == {p: n for p, n in at.items() if at.get(p - 1, 0) <= n}  # none that is the tail of another


def test_equal_words_in_text_and_item_make_no_pairs():
    import time

    index = decontaminate.build_index([("i", "go " * 1000)])
    start = time.perf_counter()
    n_words, hits, _, matches = decontaminate._scan(index, pa.record_batch({"text": ["go " * 1_000_000]}))
    assert time.perf_counter() - start < 120
    assert n_words == [1_000_000] and hits == [[(0, 1_000_000)]] and max(m["length"] for m in matches[0]) == 1000


def test_many_addresses_in_one_text():
    import time

    text = "é " + " ".join(f"user{k}@mail{k % 7}.example.com" for k in range(50_000))
    start = time.perf_counter()
    base, every = pii.all_spans(text)
    assert time.perf_counter() - start < 10 and len(base["email"]) == len(every["email"]) == 50_000


def test_byte_bpe(docs, empty):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = tokenizers_files.path("byte_bpe_multi_50k.tiktoken"), tokenizers_files.PATTERN
    ranks = byte_bpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    encoder = byte_bpe.Encoder(ranks, pattern)
    odd = ["a" * 5000, "ab" * 3000, " " * 900, "<|endoftext|>", "".join(map(chr, range(0x20, 0x2000)))]
    texts = [t or "" for _, t in corpus()] + odd
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text) and encoder.decode(ids) == text.encode()
    expected = collections.Counter()
    for doc, text in corpus():
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        expected[doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert collected(byte_bpe.round_trip(docs, path, pattern)) == expected
    both = byte_bpe.decode(byte_bpe.encode(docs, path, pattern), path, pattern)
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in both.collect())
    assert byte_bpe.round_trip(empty, path, pattern).count() == 0


def test_token_counts(docs, empty):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizers_files.path("byte_bpe_50k.json"))
    path = tokenizers_files.path("byte_bpe_50k.json")
    expected = collections.Counter()
    for doc, text in corpus():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected[doc, len((text or "").encode()), n, n > 512] += 1
    assert collected(token_counts.count_tokens(docs, path)) == expected
    assert token_counts.count_tokens(empty, path).count() == 0
    import json

    with open(path, encoding="utf-8") as file:
        counter = token_counts.Counter(json.load(file))
    shipped = token_counts.Counter(json.load(open(path, encoding="utf-8")), token_counts.proven_ids(path))
    assert shipped.proven == counter.proven and len(shipped.proven) > 10_000
    assert all(len(library.encode(t, add_special_tokens=False).ids) == 1 for t in list(shipped.proven)[::97])
    for part, key, value in ((None, "normalizer", {"type": "NFC"}), ("pre_tokenizer", "add_prefix_space", True), ("model", "ignore_merges", True)):
        model = json.load(open(path, encoding="utf-8"))
        (model[part] if part else model)[key] = value
        with pytest.raises(ValueError):
            token_counts.check_settings(model)
    texts = ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", "", "<|endof", "x" * 3000]
    assert list(counter.count(texts)) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_bpe_limits_of_groups_and_memory_change_no_result(monkeypatch):
    tiktoken = pytest.importorskip("tiktoken")
    pattern = tokenizers_files.PATTERN
    ranks = byte_bpe.read_ranks(tokenizers_files.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(8)
    texts = [" ".join("".join(rnd.choice("aeiorntéß日") for _ in range(rnd.randrange(1, 60))) for _ in range(rnd.randrange(0, 80))) for _ in range(60)]
    for name, value in (("REMEMBERED", 40), ("REMEMBERED_CHARS", 8), ("GROUP_CHARS", 320), ("MERGE_BYTES", 64)):
        monkeypatch.setattr(byte_bpe, name, value)
    encoder = byte_bpe.Encoder(ranks, pattern)
    assert [i.tolist() for i in encoder.encode(texts)] == [library.encode_ordinary(t) for t in texts]
    assert list(encoder.encode([])) == []


def test_line_counts():
    texts = [t for _, t in corpus()]
    lines = line_crf.Lines(*text_buffer(pa.array(texts, pa.string())))
    for k, text in enumerate(texts):
        text = text or ""
        words, seen, repeated = SPACED.findall(text), set(), 0
        for line in text.split("\n"):
            if SPACED.search(line):
                repeated += line in seen
                seen.add(line)
        count = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        hit = {p for i in range(len(words) - 4) if count[tuple(words[i:i + 5])] > 1 for p in range(i, i + 5)}
        mine = [int(x[k]) for x in (lines.words.counts, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words)]
        assert mine == [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(hit)], text[:60]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(4)
    for n in range(1, 8):
        scores, moves = rng.normal(size=n), rng.normal(size=(2, 2))
        best = max(((v >> np.arange(n)) & 1 for v in range(1 << n)), key=lambda y: (scores * y).sum() + sum(moves[a, b] for a, b in zip(y[:-1], y[1:])))
        assert line_crf.viterbi(scores, moves).tolist() == best.tolist()


def test_line_crf(spark, docs, empty):
    labels = spark.createDataFrame([(20, 1), (21, 0), (21, 1), (None, 1), (22, None)], "doc_id long, quality int")
    found = {r.doc_id: r for r in line_crf.quality_rules(docs, labels).collect()}
    assert found[0].n_words == 0 and found[0].base_failed and not found[0].kept
    assert found[15].base_failed and not found[15].kept
    assert line_crf.quality_rules(empty, labels.where("false")).count() == 0
    good, junk = "The quick brown fox ran over the hill today.\nIt was a fine day for all of them.", "HOME | NEWS | SHOP | ABOUT\nBUY NOW!! ### $$$ %%%\nMENU | LOGIN | HELP ### $$$"
    rows = spark.createDataFrame([(1, good), (2, junk)], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in line_crf.judge(rows, line_crf.PRIOR, line_crf.PRIOR_MOVES).collect()} == {1: True, 2: False}


def test_line_crf_learns_from_a_sample_bounded_in_lines(spark):
    """A labelled text of very many lines changes no weight and is judged whole."""
    good, junk = "The quick brown fox ran over the hill today.\nIt was a fine day for all of them.", "HOME | NEWS | SHOP\nBUY NOW!! ### $$$ %%%\nMENU | LOGIN | HELP ### $$$"
    rows = [(k, good if k % 2 else junk) for k in range(20)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(21)], "doc_id long, quality int")
    few = line_crf.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    long_text = "\n".join(f"Line {k} says something of its own." for k in range(100_000))
    docs = spark.createDataFrame(rows + [(20, long_text)], "doc_id long, text string")
    many = line_crf.train(docs, labels)
    assert all(np.array_equal(a, b) for a, b in zip(few, many))
    assert {r.doc_id: r.n_words for r in line_crf.judge(docs, *many).collect()}[20] == 700_000


DISGUISES = [
    ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("john at mail dot example dot com", "email", "john at mail dot example dot com"),
    ("see jоhn@exаmple.com here", "email", "jоhn@exаmple.com"),
    ("card ４５３９ 1488 0343 6467.", "card", "４５３９ 1488 0343 6467"),
    ("call plus four one five five five five one two three four ok", "phone", "plus four one five five five five one two three four"),
    ("host 192[.]168[.]1[.]20 down", "ip", "192[.]168[.]1[.]20"),
]


@pytest.mark.parametrize("text, kind, span", DISGUISES)
def test_disguises(text, kind, span):
    base, every = pii.all_spans(text)
    assert [text[s:e] for s, e in every[kind]] == [span] and not any(base.values())
    assert pii.redact(text) == text.replace(span, f"[{kind.upper()}]")


def test_base_spans():
    rnd = random.Random(1)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card = re.compile(r"[0-9]([\x20-]?[0-9])+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    for _ in range(4000):
        text = "".join(rnd.choice("ab@.@..1203456-+ ()%") for _ in range(60))
        base = pii.base_spans(text)
        assert base["email"] == [m.span() for m in email.finditer(text)]
        assert base["ip"] == [m.span() for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        assert base["card"] == [m.span() for m in card.finditer(text) if 16 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and pii._luhn(d)]
        assert base["phone"] == [m.span() for m in phone.finditer(text) if 8 <= len(re.findall("[0-9]", m[0])) <= 15]


def test_personal_data(spark, docs, empty):
    rows = spark.createDataFrame([(1, "a@b.co and a@b.co", 17), (2, None, 0), (3, "plain text at home", 18)], "doc_id long, text string, n_chars long")
    found = {r.doc_id: r for r in pii.find_personal_data(rows).collect()}
    assert found[1].spans == "email:0:6,email:11:17" and found[1].n_email == 2 and found[3].spans == "" == found[2].spans
    clean = {r.doc_id: (r.text, r.n_chars) for r in pii.redact_documents(rows).collect()}
    assert clean == {1: ("[EMAIL] and [EMAIL]", 19), 2: (None, 0), 3: ("plain text at home", 18)}
    assert pii.redact_documents(docs).columns == docs.columns and pii.find_personal_data(empty).count() == 0


def test_drop_keeps_other_texts_of_one_id(spark):
    """A doc_id with two texts is two documents here, each judged by its own fingerprint."""
    far = " ".join(f"other{k}" for k in range(40))
    near = " ".join(f"w{k}" for k in range(60))
    rows = [(5, near, {"a": 1}), (5, far, {"a": 2}), (5, near, {"a": 1}), (7, far, None), (9, "third text of its own", None), (None, near, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found map<string,int>")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert collections.Counter((r.doc_id, r.text) for r in kept.collect()) == collections.Counter([(5, near), (5, far), (9, "third text of its own"), (None, near)])


def test_stable_under_partitioning(docs):
    other = docs.repartition(7, F.col("n_chars"))
    assert collected(simhash.near_duplicates(docs)) == collected(simhash.near_duplicates(other))
    assert collected(super_kmers.remove_repeats(docs)) == collected(super_kmers.remove_repeats(other))
