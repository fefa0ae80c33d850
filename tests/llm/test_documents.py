"""Document operators against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from shopgrain.llm import (
    bin_completion,
    exact_dedup,
    hyperminhash,
    hyperminhash_sketch,
    packing,
    quality_rules,
    sentencepiece_bpe,
    string_kernel,
)
from shopgrain.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(row):
    return tuple((v is None, v) for v in row)


# exact duplicates


def brute_groups(rows):
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc_id, text or ""))
    out = []
    for norm, group in texts.items():
        group.sort(key=lambda r: (-len(r[1]), r[0] is None, r[0]))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(r[0], group[0][0], len(group), i == 0, sha) for i, r in enumerate(group)]
    return sorted(out, key=key)


def test_exact_groups(spark, edge, documents, empty):
    for df in (edge, documents, empty):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        found = sorted((tuple(r) for r in exact_dedup.groups(df).collect()), key=key)
        assert found == brute_groups(rows)


def test_exact_groups_span_ranges(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    found = sorted((tuple(r) for r in exact_dedup.groups(df).collect()), key=key)
    assert found == brute_groups(rows)


def test_exact_keeps_whole_rows(edge, empty):
    kept = exact_dedup.deduplicated(edge)
    assert kept.columns == edge.columns
    rows = kept.collect()
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in rows]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in edge.collect()})
    assert {tuple(r) for r in rows} <= {tuple(r) for r in edge.collect()}
    assert exact_dedup.deduplicated(empty).columns == empty.columns
    assert exact_dedup.deduplicated(empty).count() == 0


# quality rules


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + o for at in windows.values() if len(at) > 1 for i in at for o in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_ledger(edge, documents, empty):
    for df in (edge, documents, empty):
        found = quality_rules.ledger(df).collect()
        texts = [r.text for r in df.collect()]
        assert Counter(tuple(r[m] for m in quality_rules.MEASUREMENTS) for r in found) == Counter(map(brute_quality, texts))


def test_quality_policies_and_ablations(documents):
    ledger = quality_rules.ledger(documents).collect()
    policy = quality_rules.STANDARD
    found = {r["rule"]: (r["failed"], r["only"], r["documents"]) for r in quality_rules.ablations(quality_rules.ledger(documents), policy).collect()}
    for rule, bit in quality_rules.BITS.items():
        failed = sum(bool(r["failed"] & bit) for r in ledger)
        assert found[rule] == (failed, sum(r["failed"] == bit for r in ledger), len(ledger))
    kept = quality_rules.verdicts(quality_rules.ledger(documents), quality_rules.BASE).where("kept").count()
    assert kept == sum(not r["failed"] & quality_rules.BASE.mask for r in ledger)


def test_quality_filter_keeps_columns(edge):
    kept = quality_rules.filtered(edge)
    assert kept.columns == edge.columns
    assert {r.doc_id for r in kept.collect()} <= {1, 2, 7, 10, 11, 12, None}


# SentencePiece


@pytest.fixture(scope="module")
def piece_model():
    return public_tokenizers.path("piece_bpe_32k.model")


def test_encoding_is_the_library_s(spark, edge, documents, piece_model):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=piece_model)
    for df in (edge, documents):
        expected = Counter()
        for r in df.collect():
            ids = library.encode(r.text or "", add_bos=True, add_eos=True)
            raw = np.array(ids, "<u4").tobytes()
            decoded = library.decode(ids).encode()
            expected[(r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest())] += 1
        assert Counter(map(tuple, sentencepiece_bpe.digests(df, piece_model).collect())) == expected


def test_backtracking_on_odd_strings(piece_model):
    from sentencepiece import SentencePieceProcessor

    library, own = SentencePieceProcessor(model_file=piece_model), sentencepiece_bpe.Vocabulary(piece_model)
    rng = np.random.default_rng(5)
    letters = [*"aabcdeeehilnorst    ▁\n\t<>#-=.,'é中😀\x00ß", "ing", " the", "    ", "aaaa", "----", "<s>", "<0x41>"]
    texts = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(3000)]
    for text in [*texts, "a" * 3000, " " * 1000, "ab" * 1000]:
        ids = np.array(library.encode(text, add_bos=True, add_eos=True), "<u4")
        assert own.encode(text) == ids.tobytes()
        assert own.decode(ids.tobytes()) == library.decode(ids.tolist())


def test_encode_decode_round_trip(documents, empty, piece_model):
    ids = sentencepiece_bpe.encoded(documents, piece_model)
    texts = {r.doc_id: r.text for r in sentencepiece_bpe.decoded(ids, piece_model).collect()}
    assert texts == {r.doc_id: r.text for r in documents.collect()}
    assert sentencepiece_bpe.digests(empty, piece_model).count() == 0


# languages


def test_languages_held_out(spark, documents):
    model = string_kernel.train(documents)
    lang = {r.doc_id: r.lang for r in documents.collect()}
    found = string_kernel.predicted(documents, model).collect()
    assert len(found) == len(lang)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held) > 0


def test_languages_never_read_from_labels(spark, documents):
    model = string_kernel.train(documents)
    other = documents.selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source")
    one = string_kernel.predicted(documents, model).select("doc_id", "lang_pred", "score")
    two = string_kernel.predicted(other, model).select("doc_id", "lang_pred", "score")
    assert one.exceptAll(two).count() == 0


def test_language_edges(spark, edge, empty):
    model = string_kernel.train(edge)
    rows = string_kernel.predicted(edge, model).collect()
    by_text = dict(zip([r.text for r in edge.collect()], rows, strict=True))
    for text in (None, "", " \n\t ", "### *** 123 456"):
        assert (by_text[text].lang_pred, by_text[text].score) == ("und", 0.0)
    assert len(rows) == edge.count()
    nothing = string_kernel.train(empty)
    assert string_kernel.predicted(empty, nothing).count() == 0
    assert {r.lang_pred for r in string_kernel.predicted(edge, nothing).collect()} == {"und"}
    kept = string_kernel.known(edge, model)
    assert kept.columns == edge.columns
    assert kept.count() == sum(r.lang_pred != "und" for r in rows)


# near duplicates


def brute_components(rows):
    sets = []
    for doc_id, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for shingle in s:
            holders[shingle].append(i)
    shared = Counter((a, b) for at in holders.values() for k, b in enumerate(at) for a in at[:k])
    for (a, b), both in shared.items():
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root(i)] = min(doc_id, smallest.get(root(i), doc_id))
    return sorted(
        (
            (d, len(sets[i]), smallest.get(root(i)) if sets[i] else d, not sets[i] or (d is not None and d == smallest.get(root(i))))
            for i, (d, _) in enumerate(rows)
        ),
        key=key,
    )


def test_near_components(edge, documents, empty):
    for df in (edge, documents, empty):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        assert sorted((tuple(r) for r in hyperminhash.groups(df).collect()), key=key) == brute_components(rows)


def test_near_group_of_many_copies(spark, monkeypatch):
    monkeypatch.setattr(hyperminhash, "BLOCK", 16)
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = list(rng.choice(vocabulary, 60))
    base = list(rng.choice(vocabulary, 150))
    rows = []
    for i in range(240):
        words = base.copy()
        if i % 3 == 0:  # a passage in common, but no near copy
            words = list(rng.choice(vocabulary, 150)) + passage
        for _ in range(int(rng.integers(0, 6))):
            words[int(rng.integers(0, len(words)))] = f"x{int(rng.integers(0, 50))}"
        rows.append((1000 - i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in hyperminhash.groups(df).collect()), key=key) == brute_components(rows)


def test_near_pair_with_an_earlier_band_alike_in_low_bits_only(spark):
    """Texts that link, share no band before one that is alike in the low eight bits only,
    and share each band with a smaller id too, which neither of them links with."""
    sketch, rng = hyperminhash_sketch, np.random.default_rng(5)
    windows = lambda words: [" ".join(words[i : i + 5]) for i in range(len(words) - 4)]
    for _ in range(5000):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 1500)]
        other = words.copy()
        for at in rng.choice(1500, 36, replace=False):
            other[int(at)] = f"x{int(rng.integers(0, 10**6))}"
        sets = [sketch.shingles(" ".join(x).encode()) for x in (words, other)]
        a, b = (sketch.registers(x)[sketch.IN_BAND] for x in sets)
        alike = (a == b).all(axis=1) & (a != sketch.EMPTY).any(axis=1)
        low = ((a & 0xFF) == (b & 0xFF)).all(axis=1) & (a != sketch.EMPTY).all(axis=1)
        if alike.any() and low.argmax() < alike.argmax() and sketch.linked(*sets, 75):
            break
    else:
        raise AssertionError("no such pair")
    of = {}  # the window that each register stands for
    for window in windows(words):
        hashed = sketch.shingles(window.encode())
        bucket = int(hashed[0] >> np.uint64(56))
        if sketch.registers(hashed)[bucket] == sketch.registers(sets[0])[bucket]:
            of[bucket] = window
    rows = [(1001, " ".join(words)), (1002, " ".join(other))]
    for n, band in enumerate(np.flatnonzero(alike)):
        at = sketch.IN_BAND[band]
        texts = (f" between{k} ".join(of[i] for i in at.tolist()) for k in range(1000))
        rows.append((n, next(x for x in texts if (sketch.registers(sketch.shingles(x.encode()))[at] == a[band]).all())))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in hyperminhash.groups(df).collect()), key=key)
    assert found == brute_components(rows) and found[-1][2] == 1001


def test_near_keeps_whole_rows(edge):
    kept = hyperminhash.deduplicated(edge)
    assert kept.columns == edge.columns
    rows = edge.collect()
    stays = Counter(r.doc_id for r in hyperminhash.groups(edge).where("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == stays
    assert stays == Counter(r[0] for r in brute_components([(r.doc_id, r.text) for r in rows]) if r[3])


def test_near_rows_that_share_an_id(spark):
    """Rows go by id and text: another text of the same id stays."""
    a, b, c = ("one two three four five six", "red green blue black white grey", "ash oak elm fir yew box")
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "y"), (None, b, "z"), (None, c, "z"), (None, "", "z"), (3, b, "w"), (2, b, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_a string")
    kept = sorted((tuple(r) for r in hyperminhash.deduplicated(df).collect()), key=key)
    assert kept == sorted([(1, a, "x"), (2, b, "y"), (2, b, "v"), (None, "", "z")], key=key)


def test_sketch_estimates_and_registers():
    rng = np.random.default_rng(1)
    for _ in range(50):
        both = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * 2 + 1
        a, b = np.unique(both[:350]), np.unique(both[50:])
        small = hyperminhash_sketch.small(np.stack([hyperminhash_sketch.registers(x) for x in (a, b)]))
        assert hyperminhash_sketch.may_link(small[:1], small[1:], np.array([350]), np.array([350]), 75)[0]
    assert (hyperminhash_sketch.registers(np.empty(0, np.uint64)) == hyperminhash_sketch.EMPTY).all()


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 5), (7, 7), (200, 201), (201, 200), (300, None)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}
    assert components(df.limit(0)).count() == 0


def test_languages_are_not_pushed_out(spark):
    """Rows that share an id, or have none, and copies leave room for all languages."""
    words = {"en": "the and of with from about", "de": "der die und nicht auch eine", "fr": "le les des une dans pour"}
    rng, rows = np.random.default_rng(6), []
    for lang, n in (("fr", 6000), ("en", 900), ("de", 900)):
        for i in range(n):
            text = " ".join(rng.choice(words[lang].split(), 12))
            rows.append((1 if lang == "fr" else None if i % 2 else int(rng.integers(10**6)), text, lang))
    copy, other = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2][-2:]
    rows += [(copy, "la la la la la", "it")] * 3000 + [(other, "uno due tre quattro", "it")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts, languages = string_kernel.sample(df, "doc_id", "text", "lang")
    counts = Counter(languages)
    each = string_kernel.TRAIN_ROWS // 4
    assert counts["fr"] == counts["en"] == counts["de"] == each and counts["it"] == 2
    assert len(set(zip(texts, languages, strict=True))) > 3 * each * 0.9
    shuffled = df.repartition(7)
    assert string_kernel.sample(shuffled, "doc_id", "text", "lang") == (texts, languages)
    assert set(string_kernel.train(df).languages) == {"de", "en", "fr", "it"}


# packing


def test_bin_completion_is_valid_and_often_best():
    rng = np.random.default_rng(0)
    best = 0
    for _ in range(150):
        capacity = int(rng.integers(5, 40))
        counts = np.bincount(rng.integers(1, capacity + 1, int(rng.integers(1, 30))), minlength=capacity + 1)
        patterns = bin_completion.pack(counts, capacity)
        used = np.zeros(capacity + 1, int)
        for times, lengths in patterns:
            assert times > 0 and sum(lengths) <= capacity
            np.add.at(used, list(lengths), times)
        assert (used == counts).all()
        n = sum(times for times, _ in patterns)
        assert n <= sum(times for times, _ in bin_completion.best_fit(counts, capacity))
        best += n == bin_completion.lower_bound(counts, capacity)
    assert best >= 140
    assert bin_completion.pack(np.zeros(9, int), 8) == []


def test_packing(edge, documents, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for df in (edge, documents):
        rows = packing.packed(df, path).collect()
        sequences = defaultdict(list)
        for r in rows:
            sequences[r.sequence_id].append((r.offset, r.length))
        for places in sequences.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 2048
        expected = Counter()
        for r in df.collect():
            ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
            for piece, at in enumerate(range(0, len(ids), 2048)):
                part = ids[at : at + 2048]
                expected[(r.doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
        tokens = sum(r.length for r in rows)
        assert len(sequences) <= 1.02 * tokens / 2048 + 2
    assert packing.packed(empty, path).count() == 0


def test_words_are_encoded_as_texts_are(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "REMEMBERED", 500)  # so that words are forgotten and met again
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, words = Tokenizer.from_file(path), packing._Words(path)
    rng = np.random.default_rng(4)
    letters = [*"aAbEetsSTÉé́Σσİ.,'-<>|12½ \n\t中😀\x85\x1cŉßɐ", "'s", "<|endoftext|>", "<|ENDOFTEXT|>", "...", "the", " "]
    texts = ["".join(rng.choice(letters, rng.integers(0, 25))) for _ in range(3000)]
    for start in range(0, len(texts), 300):
        some = texts[start : start + 300]
        ids, ends = words.encoded(pa.array(some, pa.large_string()))
        for text, found in zip(some, np.split(ids, ends[:-1]), strict=True):
            assert found.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_bin_completion_finds_the_fewest_bins():
    rng = np.random.default_rng(2)
    for _ in range(150):
        capacity, n = int(rng.integers(8, 40)), int(rng.integers(1, 11))
        items = [int(x) for x in rng.integers(max(1, capacity // 8), max(2, capacity * 3 // 4), n)]
        least = [(0, 0)] + [(n + 1, 0)] * ((1 << n) - 1)  # (full bins, load of the last) by set of items
        for chosen in range(1, 1 << n):
            for i in range(n):
                if chosen >> i & 1:
                    bins, load = least[chosen ^ (1 << i)]
                    if bins == 0 or load + items[i] > capacity:
                        bins, load = bins + 1, 0
                    least[chosen] = min(least[chosen], (bins, load + items[i]))
        counts = np.bincount(items, minlength=capacity + 1)
        assert sum(times for times, _ in bin_completion.pack(counts, capacity)) == least[-1][0]


def test_fillings_leave_nothing_out_but_dominated_ones():
    rng = np.random.default_rng(3)
    for _ in range(60):
        room = int(rng.integers(5, 16))
        counts = [0, *(int(x) for x in rng.integers(0, 3, room - 1)), 0]
        reach = bin_completion._reachable(counts, room)
        found = list(bin_completion.fillings(counts, room, reach, room, [10**6]))
        sets = [()]
        for length in range(room, 0, -1):
            sets = [s + (length,) * k for s in sets for k in range(counts[length] + 1) if sum(s) + k * length <= room]

        def beaten(s):
            for size in range(1, 1 << len(s)):
                part = [x for i, x in enumerate(s) if size >> i & 1]
                for x in range(sum(part), sum(part) + room - sum(s) + 1):
                    if x <= room and counts[x] > s.count(x) and (len(part) > 1 or x > part[0]):
                        return True
            return False

        # An item may also be added to what has room for it: the empty subset.
        full = lambda s: not any(counts[x] > s.count(x) for x in range(1, room - sum(s) + 1))
        expected = {s for s in sets if not beaten(s) and full(s)}
        assert expected == set(found) and len(found) == len(expected)
        assert [sum(s) for s in found] == sorted((sum(s) for s in found), reverse=True)
