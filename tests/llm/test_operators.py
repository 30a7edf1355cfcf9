"""Each operator against a brute-force version, and on rows that are odd in some way."""

import hashlib
import os
import random
import subprocess
import sys
import time
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import chat, decontam, html, langid, neardup, packing, pii, quality, queries, sharding, substring, tokens

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def vocabulary(n=60, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefgéß") for _ in range(r.randint(2, 6))) for _ in range(n)]


def odd_rows(seed=0):
    """Documents with copies, shared passages, blanks, nulls, one long text and constant runs."""
    r, words = random.Random(seed), vocabulary()
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    base, passage = [text(80) for _ in range(6)], text(45)
    rows = [None, "", " \n\t ", "one", "One ONE", text(19), text(20), "la " * 70, text(4000)]
    rows += base + base[:3] + base[:1] * 5
    for b in base:
        w = b.split()
        w[r.randrange(len(w))] = "zzz"
        rows.append(" ".join(w))
        rows.append(text(30) + "  " + passage + "\n" + text(10))
    r.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def odd():
    return odd_rows()


def frame(spark, rows):
    """As documents, with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(d, t, "en" if t and len(t) % 2 else None, None, None) for d, t in rows], DOC).withColumn("LANG_PRED", F.lit("x")).withColumn("row", F.lit(1)).withColumn("n_entities", F.lit("?")).withColumn("comp", F.lit(0)).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOC)


def test_substring_matches_brute_force(spark, odd):
    for buckets in (1, 16):
        out = substring.remove_repeats(frame(spark, odd), buckets=buckets).collect()
        got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in out}
        assert got == brute.substring(odd)


def test_super_kmers_cover_every_window_once():
    words = [b"w%d" % (i * i % 11) for i in range(90)]
    data = b" ".join(words)
    hashes, begin, end = substring.hashed_words(data)
    common = np.sort(substring.shingles(hashes, 4)[::3])
    spans = [(a, n, packed.split()) for _, a, n, packed in substring.super_kmers(data, begin, end, hashes, 20, common)]
    assert [a for a, _, _ in spans] == [0, *np.cumsum([n for _, n, _ in spans])[:-1]] and sum(n for _, n, _ in spans) == 71
    assert all(w == words[a : a + n + 19] for a, n, w in spans)


def test_words_hash_by_their_bytes():
    r = random.Random(9)
    words = [bytes(r.randrange(33, 256) for _ in range(n)) for n in (1, 2, 7, 8, 9, 15, 16, 17, 40, 300)]
    words += [w[:-1] + b"!" for w in words] + [w + b"\0" for w in words] + words
    hashes, begin, end = substring.hashed_words(b" ".join(words[:20]) + b"\n" + b" ".join(words[20:]))
    assert len({w: h for w, h in zip(words, hashes.tolist(), strict=True)}) == len(set(hashes.tolist())) == len(set(words))
    assert (hashes[:10] == hashes[30:]).all() and (end - begin).tolist() == [len(w) for w in words] and not len(substring.hashed_words(b"")[0])


def test_substring_compares_words_where_hashes_collide(odd):
    """Every word has one hash: windows are told apart by their words, in one round or several."""
    docs = [(d, t.encode().split()) for d, t in odd if t and len(t.split()) >= 20][:14]
    strings = [(d, i, b" ".join(w[i : i + 25])) for d, w in docs for i in range(0, min(len(w), 120) - 24, 6)]
    heads = {"doc": [d for d, _, _ in strings], "tie": [0] * len(strings), "start": [i for _, i, _ in strings], "windows": [6] * len(strings)}
    args = {k: np.array(v, np.int64) for k, v in heads.items()}, b"\n".join(x for _, _, x in strings)
    same = lambda data: (np.zeros(len(data.split()), np.uint64), *substring.hashed_words(data)[1:])
    want, got = (substring.marked_windows(*args, 20, h) for h in (substring.hashed_words, same))
    assert len(want[0]) and sorted(zip(*(x.tolist() for x in want[:3]), strict=True)) == sorted(zip(*(x.tolist() for x in got[:3]), strict=True))


def test_substring_buckets_read_in_many_rounds(spark, odd, monkeypatch):
    monkeypatch.setattr(substring, "SORT_BYTES", 2000)
    monkeypatch.setattr(substring, "PACK_BYTES", 1500)
    monkeypatch.setattr(substring, "COMMON", 2)
    out = substring.remove_repeats(frame(spark, odd), buckets=2).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in out} == brute.substring(odd)


def test_substring_one_id_with_two_texts(spark):
    long, other = " ".join(f"w{i}" for i in range(160)), " ".join(f"w{i}" for i in range(100, 140))
    rows = [(1, long), (1, "a b c d e"), (0, other), (1, other), (2, long)]
    out = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == [(0, 40, 0), (1, 5, 0), (1, 40, 40), (1, 160, 40), (2, 160, 160)]


def test_substring_repeated_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, long), (1, long), (2, long), (None, long), (None, long)]
    out = sorted(((r.doc_id, r.n_removed) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert out == [(1, 0), (1, 0), (2, 30), (None, 0), (None, 0)]
    assert substring.remove_repeats(empty(spark)).count() == 0


def test_neardup_matches_brute_force(spark, odd):
    for k in (4, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame(spark, odd), k).collect()}
        assert got == brute.near_duplicates(odd, k)


def test_neardup_chain_and_foreign_members(spark):
    """A chain of edits whose ends are not alike, and postings that hold several components, need more than stars."""
    words = [f"w{i}" for i in range(200)]
    rows, now = [], list(words)
    for i in range(14):
        rows.append((100 - i, " ".join(now)))
        now[14 * i : 14 * i + 4] = [f"x{i}_{j}" for j in range(4)]
    rows += [(200 + i, " ".join(words[:100] + [f"y{i}_{j}" for j in range(100)])) for i in range(9)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
    assert got == brute.near_duplicates(rows, 4)


def family(n, part=0.6, length=200, seed=3):
    """Texts that share a template and are not alike: every pair is of a similarity under the threshold."""
    r = random.Random(seed)
    shared = [f"t{i}" for i in range(int(length * part))]
    return [" ".join(shared + [f"u{i}_{r.randrange(10**9)}" for _ in range(length - len(shared))]) for i in range(n)]


def test_neardup_counts_collisions():
    """Partners are the pairs above the threshold whose first common coordinate is the posting's, however many there are."""
    r = np.random.RandomState(5)
    base = r.randint(0, 1 << 32, (1, neardup.COORDINATES, neardup.ROWS), dtype=np.uint64).astype(np.uint32)
    sig = np.repeat(base, 60, 0)
    fresh = r.rand(*sig.shape) < r.rand(60, 1, 1) * 0.5
    sig[fresh] = r.randint(0, 1 << 32, fresh.sum(), dtype=np.uint64).astype(np.uint32)
    same = sig[:, None] == sig[None]
    whole = same.all(3)
    for first in (0, 3):
        ok = (same.sum((2, 3)) >= neardup.AGREEING) & (whole.sum(2) >= neardup.MATCHES) & ~whole[:, :, :first].any(2) & ~np.eye(60, dtype=bool)
        on = np.flatnonzero((sig[:, first] == base[0, first]).all(1))
        for few in (0, 10**6):
            neardup.FEW_PAIRS, kept = few, neardup.FEW_PAIRS
            left, right = neardup.partners(sig[on], sig[on], first, None, 80, ~np.eye(len(on), dtype=bool))
            neardup.FEW_PAIRS = kept
            assert left.tolist() == right.tolist() == ok[on][:, on].any(1).tolist() and 0 < left.sum()


def test_neardup_sends_texts_of_partners_only(spark, monkeypatch):
    """A family under the threshold shares postings, and hardly any text travels; links inside it are still found."""
    rows = list(enumerate(family(150, 0.7)))
    rows += [(1000 + i, t + " more words") for i, t in rows[:40]]
    sent = []
    keep = neardup.written
    monkeypatch.setattr(neardup, "written", lambda df, tag: [t := keep(df, tag), sent.append(t.count()) if tag == "nd-named" else None][0])
    for block in (2048, 32):
        monkeypatch.setattr(neardup, "BLOCK", block)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()}
        assert got == brute.near_duplicates(rows, 4)
    assert sent[0] < 2 * len(rows)


def test_neardup_odd_ids(spark):
    a, b = "a b c d e f", " ".join(f"w{i}" for i in range(30))
    rows = [(5, a), (5, a), (None, a), (3, "A b c d e f"), (9, None), (9, ""), (7, b), (7, "x y z x y z"), (7, b + " "), (6, b)]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    out = sorted(((r.doc_id, r.component_id, r.kept) for r in found), key=str)
    assert out == sorted([(3, 3, True), (5, 3, False), (5, 3, False), (6, 6, True), (7, 6, False), (7, 6, False), (7, 7, True), (9, 9, True), (9, 9, True), (None, None, True)], key=str)
    assert sorted((r.doc_id, r.n_shingles) for r in found if r.first and r.n_shingles and r.doc_id) == [(3, 2), (6, 26), (7, 2)]
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.comp for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {x: got.get(x, x) for x in parent} == {x: find(x) for x in parent}


def test_quality_rules_match_brute_force(spark, odd):
    out = quality.judged(frame(spark, odd)).collect()
    want = {d: brute.rules(t) for d, t in odd}
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out} == want
    assert all(not r.kept for r in out if r.base_failed) and quality.judged(empty(spark)).count() == 0


def test_kneser_ney_matches_a_slow_version(spark):
    """Counts by documents, probabilities of all orders and back-off weights, and what each context adds up to."""
    texts = ["the cat sat on the mat " * 3, "The cat ate the rat 12", "Кот и код, кот", "the mat 99", "", "a dog"] + [f"the cat no {i}" for i in range(6)]
    docs = spark.createDataFrame([("en", t) for t in texts] + [("x", "abc abc")], "lang string, text string").repartition(3)
    counted = quality.count(docs)
    huge = "the cat 7 " * 450_000
    both = {r.key: r.n for r in quality.count(spark.createDataFrame([("en", huge), ("en", huge + "é"), ("en", "the")], "lang string, text string")).collect()}
    assert both == brute.gram_counts([huge, huge + "é", "the"], quality.ORDER)
    own = [t for t in texts if t]
    want = brute.gram_counts(own, quality.ORDER)
    assert {r.key: r.n for r in counted.where("lang = 'en'").collect()} == want
    entries, contexts = quality.estimate(counted)
    p, gamma = brute.kneser_ney(want, quality.ORDER)
    got = {(r.k, r.key): r.p for r in entries.where("lang = 'en'").collect()}
    assert got.keys() == p.keys() and all(got[g] == pytest.approx(p[g], rel=1e-9) for g in p)
    ways = {(r.k, r.key): r.gamma for r in contexts.where("lang = 'en'").collect()}
    assert ways.keys() == gamma.keys() and all(ways[h] == pytest.approx(gamma[h], rel=1e-9) for h in gamma)
    full = quality.NgramModel(("en",), quality._arrays(entries, "p"), quality._arrays(contexts, "gamma"))
    for history in (b"the c", b"zzzzz", b" mat ", "ко".encode() + b" "):
        keys = np.array([int.from_bytes(history[-5:] + bytes([c]), "big") for c in range(256)], np.uint64)
        assert np.exp2(-full.bits("en", keys)).sum() == pytest.approx(1, abs=1e-3)


def test_texts_do_not_vouch_for_themselves(spark):
    """What one document alone has is scored as if that document had not been counted; blocks add up to the whole."""
    texts = ["plain words again and again"] * 2 + ["plain words and no more", "qqzx vvkj wwpq"]
    entries, contexts = quality.estimate(quality.count(spark.createDataFrame([("en", t) for t in texts], "lang string, text string")))
    raws = [t.encode() for t in texts] + [b"", b"plain " * 5000]
    ((_, many, model),) = quality.blocks(entries, contexts, 1 << 20)
    assert many == 1 and not any(np.isin(quality.grams(np.frombuffer(raws[3], np.uint8).astype(np.uint64)), model.entries["en", quality.ORDER][0]))
    whole = quality.text_bits(model, raws)
    assert whole[4, 0] == 0 and whole[0, 0] / len(raws[0]) < 3 and whole[3, 0] / len(raws[3]) > 5
    long = raws[5] * 300  # a text of several runs
    assert quality.text_bits(model, [b"a", long, b"b"])[1, 0] == pytest.approx(300 * (quality.text_bits(model, [raws[5]])[0, 0]), rel=1e-3)
    cut = list(quality.blocks(entries, contexts, 600))
    assert len(cut) > 2 and np.allclose(sum(quality.text_bits(m, raws, i, n) for i, n, m in cut), whole)


def test_gibberish_in_other_scripts_is_rejected(spark):
    r = random.Random(4)
    words = ["".join(r.choice("абвгдеклмнопрст") for _ in range(r.randint(2, 7))) for _ in range(150)]
    rows = [(i, " ".join(r.choice(words) for _ in range(90)), "ru") for i in range(120)]
    rows += [(500, " ".join("".join(r.choice("фхцчшщъыьэюя") for _ in range(6)) for _ in range(90)), "ru"), (501, " ".join("".join(r.choice("абвгдеклмнопрст") for _ in range(5)) for _ in range(90)), "ru")]
    out = {x.doc_id: x.kept for x in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not out[500] and not out[501] and sum(out[i] for i in range(120)) >= 118


def test_perplexity_bands_reject_noise(spark):
    r, words = random.Random(3), vocabulary(300, 5)
    rows = [(i, " ".join(r.choice(words) for _ in range(120)), "en") for i in range(150)]
    rows.append((900, " ".join("".join(r.choice("qxzjkvw0189%$#") for _ in range(8)) for _ in range(80)), "en"))
    out = {x.doc_id: x.kept for x in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not out[900] and sum(out.values()) >= 148


def test_every_label_has_its_own_model(spark):
    r, rows = random.Random(9), []
    for k in range(20):
        letters = r.sample("abcdefghijklmnopqrstuvwxyz", 6)
        words = ["".join(r.choice(letters) for _ in range(5)) for _ in range(40)]
        rows += [(100 * k + i, " ".join(r.choice(words) for _ in range(80)), f"l{k:02}") for i in range(6)]
    out = {x.doc_id: x.lang for x in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert out == {d: lang for d, _, lang in rows}


def test_decontamination_matches_brute_force(spark):
    r, words = random.Random(8), vocabulary(40, 2)
    items = [(i, " ".join(r.choice(words) for _ in range(n))) for i, n in enumerate([1, 2, 5, 12, 13, 14, 30, 40])] + [(50, None), (51, "..."), (52, ""), (6, "b-c")]
    docs = [(0, None), (1, ""), (2, "- !"), (3, items[4][1]), (4, items[6][1].upper().replace("É", "é")), (5, "x " + items[7][1] + ", " + items[7][1])]
    docs += [(10 + i, " ".join(r.choice(words) for _ in range(150)) + "; " + (items[i % 8][1] if i % 3 else "") + " " + "É y" * i) for i in range(40)]
    for own in (items, items[4:8], []):
        out = decontam.contaminated(frame(spark, docs), spark.createDataFrame(own, "item_id long, text string")).collect()
        for x in out:
            n, hit, ids = brute.hits(dict(docs)[x.doc_id], own)
            assert (x.n_words, x.n_hit, x.item_ids, x.contaminated) == (n, hit, [str(i) for i in ids], hit > 0 and 20 * hit >= n), x.doc_id
    w = items[7][1].split()[:13]
    halves = [(None, " ".join(w[:8])), (None, " ".join(w[7:])), (7, " ".join(w)), (7, " ".join(w)), (7, "other"), (8, " ".join(w[:8])), (8, "x " * 7 + " ".join(w[7:]))]
    out = decontam.contaminated(spark.createDataFrame(halves, "doc_id long, text string"), spark.createDataFrame(items[7:8], "item_id long, text string")).collect()
    assert sorted((x.doc_id or 0, x.n_words, x.n_hit) for x in out) == [(0, 6, 0), (0, 8, 0), (7, 1, 0), (7, 13, 13), (7, 13, 13), (8, 8, 0), (8, 13, 0)]
    assert decontam.contaminated(empty(spark), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_language_id_held_out_accuracy(spark):
    out = queries.op1_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = out.join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in held)


def test_language_id_exact_code_lengths():
    labelled = [("x", b"abababab cabab"), ("y", b"zzyzzy zzy\xc3\xa9"), ("x", b"abac")]
    model = langid.fit(labelled, order=3, max_states=500)
    text = b"abab zzy q\xc3\xa9" * 300
    bits = langid.code_lengths(model, [text, b"", text[:5]])
    for i, lang in enumerate(model.languages):
        state, total = 0, 0.0
        for c in text:
            at = state * model.symbols + model.symbol[c]
            total, state = total + float(model.cost[at, i]), model.step[at]
        assert bits[0, i] == pytest.approx(total, rel=1e-6), lang
    assert (bits[1] == 0).all() and bits.shape == (3, 2)


def test_language_id_matches_a_slow_version():
    labelled = [("x", b"abababab cabab"), ("y", b"zzyzzy zzy\xc3\xa9"), ("x", b"abac"), ("y", b"the zzy")]
    model = langid.fit(labelled, order=3, max_states=500)
    texts = [b"abab zzy q\xc3\xa9", b"zzyzzyabac", b"\n", bytes(range(60, 130))]
    bits = langid.code_lengths(model, texts)
    for i, t in enumerate(texts):
        for j, lang in enumerate(model.languages):
            assert bits[i, j] == pytest.approx(brute.ppm_bits(labelled, lang, t, 3), rel=1e-5), (t, lang)


def test_language_id_odd_rows(spark, odd):
    model = langid.fit(langid.sample(frame(spark, odd), 20))
    out = {r.doc_id: r for r in langid.predict(frame(spark, odd), model).collect()}
    for d, t in odd:
        assert out[d].lang_pred == ("en" if t and t.strip() else "und")
    assert langid.predict(empty(spark), langid.fit([])).count() == 0
    assert {r.lang_pred for r in langid.predict(frame(spark, odd), langid.fit([])).collect()} == {"und"}


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_path())
    own.encode_special_tokens = True
    encode, r = tokens.Encoder(queries.tokenizer_path(), most=40), random.Random(5)
    pool = ["a", "B", "é", "'", "'s", "'ll", "re", " ", "  ", "\n", "\t", "1", "23", "!", "<|endoftext|>", "漢", "🙂", "　", "\xa0", "٣", "ſ", "\x1c", "'d"]
    for _ in range(30):
        texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 40))) for _ in range(20)]
        ids, counts = encode(texts)
        want = [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    encode = tokens.Encoder(queries.tokenizer_path())
    planes = [(0x20, 0x250), (0x250, 0x3000), (0x3000, 0xD800), (0xE000, 0x10000), (0x10000, 0x14000), (0x16000, 0x1F000), (0x1F000, 0x33480), (0xE0000, 0x110000)]
    texts = ["".join(chr(r.randrange(*r.choice(planes))) for _ in range(r.randint(1, 12))) for _ in range(20_000)] + ["\U000139da\u920c"]
    ids, counts = encode(texts)
    want = [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


#: Prints by how many MB the memory of a worker's encoder grows: for its classes, and for learning 200,000 pieces at once.
ENCODER_MEMORY = """
import re, numpy as np
from quarry.llm import packing, queries, tokens
most = lambda: int(re.search(r"VmHWM:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
path = queries.tokenizer_path()
tokens._tokenizer(path), tokens._plain(path)
at = most()
encode = tokens.encoder(path)
print(most() - at)
text = "".join(f" {i:x}" for i in range(200_000)).translate(str.maketrans("0123456789", "ghijklmnop"))
at = most()
encode([text])
print(most() - at)
"""


def test_encoder_takes_little_memory():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(queries.__file__))))
    said = subprocess.run([sys.executable, "-c", ENCODER_MEMORY], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) < 64 and int(said[1]) < 120, said


def test_tokens_in_small_blocks_are_the_same(monkeypatch):
    path = queries.tokenizer_path()
    whole, r = tokens.classes(path), random.Random(9)
    monkeypatch.setattr(tokens, "PROBE_CHARS", 1 << 12)
    monkeypatch.setattr(tokens, "LEARN_PIECES", 7)
    assert (tokens.classes.__wrapped__(path) == whole).all()
    texts = ["".join(chr(r.choice([32, 39, 49, 65, 97, 0xE9, 0x6F22, 0x1F600])) for _ in range(r.randint(0, 60))) for _ in range(300)]
    ids, counts = tokens.Encoder(path)(texts)
    want = [e.ids for e in tokens._tokenizer(path).encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


def fresh_words(seed, n=60_000):
    r = random.Random(seed)
    return [" " + "".join(r.choices("abcdefghijklmnopqrst", k=8)) for _ in range(n)]


def test_learning_moves_no_known_piece_and_costs_less_than_encoding():
    encode, spent = tokens.Encoder(queries.tokenizer_path()), []
    encode(["what was known before"])
    known, key, pool = encode.known, encode.key, encode.pool
    for seed in range(3):
        words = fresh_words(seed)
        at = time.process_time()
        ids, _ = encode(["".join(words)])
        mid = time.process_time()
        want = encode.own.encode(words, is_pretokenized=True, add_special_tokens=False).ids
        spent.append((mid - at) / (time.process_time() - mid))
        assert ids.tolist() == want
    assert encode.key is key and encode.pool is pool and encode.known > known + 150_000
    assert min(spent) < 1, spent  # the tokenizer's own way of encoding the same pieces once


@pytest.mark.parametrize("change", [lambda one: one << np.uint64(40), lambda one: one & np.uint64(15)], ids=["one slot", "one key"])
def test_tokens_are_right_whatever_the_hashes(monkeypatch, change):
    hashes = tokens.hashes
    monkeypatch.setattr(tokens, "hashes", lambda *args: (change(hashes(*args)[0]), hashes(*args)[1]))
    encode = tokens.Encoder(queries.tokenizer_path(), most=100)
    for seed in range(4):
        texts = ["".join(fresh_words(seed % 3, 300)), "", "é" * 50 + " " + "漢" * 40 + " a\x00b"]
        ids, counts = encode(texts)
        want = [e.ids for e in encode.own.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]


def test_hashes_tell_pieces_apart():
    pieces = [b"\x00" * n for n in range(2, 200)] + [b"a" * n + c for n in range(200) for c in (b"b", b"c", b"\x00")]
    ends = np.cumsum([*map(len, pieces)] * 2)
    one, two = tokens.hashes(b"".join(pieces) * 2, np.append(0, ends[:-1]), ends)
    n = len(pieces)
    assert len(set(one[:n].tolist())) == len(set(two[:n].tolist())) == n
    assert (one[:n] == one[n:]).all() and (two[:n] == two[n:]).all()


def test_ids_are_stored_in_as_many_bits_as_they_need():
    wide, ids = packing.stored(np.array([5, 6, 7], np.uint32), np.array([0, 2, 1, 0]), 1)
    assert wide.to_pylist() == [False] * 4 and [np.frombuffer(x, "<u2").tolist() for x in ids.to_pylist()] == [[1], [5, 6, 1], [7, 1], [1]]
    wide, ids = packing.stored(np.array([5, 70_000, 7], np.uint32), np.array([0, 2, 1, 0]), 1)
    assert wide.to_pylist() == [False, True, False, False] and np.frombuffer(ids[1].as_py(), "<u4").tolist() == [5, 70_000, 1]
    wide, ids = packing.stored(np.zeros(0, np.uint32), np.zeros(0, np.int64), 1)
    assert len(wide) == len(ids) == 0


def test_packing_in_small_blocks_is_the_same(spark, odd, monkeypatch):
    want = sorted(map(tuple, packing.pack(frame(spark, odd), queries.tokenizer_path(), length=64).collect()), key=str)
    for size in (1, 50):
        monkeypatch.setattr(packing, "ENCODE_BYTES", size)
        assert sorted(map(tuple, packing.pack(frame(spark, odd), queries.tokenizer_path(), length=64).collect()), key=str) == want


def test_hilbert_walks_through_neighbours():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    by = grid[np.argsort(packing.hilbert(grid, 3))]
    assert sorted(packing.hilbert(grid, 3)) == list(range(512)) and (np.abs(np.diff(by, axis=0)).sum(1) == 1).all()


def test_packing_tiles_every_document(spark, odd):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_path())
    out = packing.pack(frame(spark, odd), queries.tokenizer_path(), length=64).collect()
    want = {d: np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in odd}
    for d, ids in want.items():
        pieces = sorted((r.start, bytes(r.ids)) for r in out if r.doc_id == d)
        assert b"".join(p for _, p in pieces) == ids.tobytes() and [s for s, _ in pieces] == [0, *np.cumsum([len(p) // 4 for _, p in pieces])[:-1]]
    spots = sorted((r.sequence_id, r.offset, r.length) for r in out)
    flat = np.cumsum([0] + [n for _, _, n in spots])
    assert [s * 64 + o for s, o, _ in spots] == flat[:-1].tolist()
    assert packing.pack(empty(spark), queries.tokenizer_path()).count() == 0
    assert packing.pack(spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string"), queries.tokenizer_path()).count() == 3


def test_chat_offsets_equal_the_tokenizer():
    path, r = queries.tokenizer_path(), random.Random(2)
    pool = ["a", " the", "É", "漢", "🙂", "\n", "  ", "<s>", "</s>", "[INST]", "[/INST]", "<", "/s>", "'ll", "12", "\xa0", "e\u0301", "<|endoftext|>"]
    texts = ["", "<s>", "x", *("".join(r.choice(pool) for _ in range(r.randint(0, 30))) for _ in range(200))]
    for (ids, offsets), want in zip(chat.encode(path, texts), chat.tokenizer(path).encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == want.ids and [tuple(o) for o in offsets.tolist()] == list(want.offsets)


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "[\\\\/INST]", "[INST", "INST]", "", None, "é\r\n\x85 🙂 <", "</s", "a\\", "<<s>>", "[[INST]]"]
    rows = [(c, t, role, nasty[(c * 5 + t) % len(nasty)]) for c in range(30) for t, role in enumerate(["system", "user", "assistant", "user", "assistant", None])]
    rows += [(None, None, "assistant", "x"), (40, 1, "assistant", "b"), (40, 0, "[/INST]", "a"), (40, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).repartition(4)
    made = chat.format_conversations(df, queries.tokenizer_path())
    got = {r.conv_id: r for r in made.collect()}
    out = {r.conv_id: r for r in chat.digests(made).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c in {r[0] for r in rows}:
        own = [(role or "", text or "") for _, _, role, text in sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] or 0, r[2] or "", r[3] or ""))]
        if c not in (None, 40):
            own = [(role or "", text or "") for _, _, role, text in [r for r in rows if r[0] == c]]
        loss = "".join(t for role, t in own if role == "assistant")
        assert chat.parse(got[c].formatted) == own and out[c].n_turns == len(own)
        assert out[c].turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in own))
        assert (out[c].loss_chars, out[c].loss_sha256, out[c].formatted_chars) == (len(loss), sha(loss), len(got[c].formatted))
    assert chat.format_conversations(df.limit(0), queries.tokenizer_path()).count() == 0


def test_sharding_law_and_links(spark, odd):
    rows = odd + [(1000 + i, "hot text") for i in range(60)]
    out = sharding.propagate(frame(spark, rows), shards=4).collect()
    assert len(out) == len(rows) and {r.law for r in out} == {"rows"}
    slots = {s: sorted(r.slot for r in out if r.shard == s) for s in range(4)}
    assert all(v == list(range(len(v))) for v in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for r in out:
        raw = (dict(rows)[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    assert len({r.shard for r in out if r.doc_id >= 1000}) <= 4
    assert sharding.propagate(empty(spark)).count() == 0


def test_sharding_keeps_large_groups_together(spark):
    sizes = {"third": 333, "a": 100, "b": 100, "c": 60, "d": 45}
    rows = [t for t, n in sizes.items() for _ in range(n)]
    rows += [f"single {i}" for i in range(1000 - len(rows))]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    out = sharding.propagate(docs).collect()
    on = {t: len({r.shard for r in out if rows[r.doc_id] == t}) for t in sizes}
    assert on == {"third": 3, "a": 1, "b": 1, "c": 1, "d": 1}
    assert {sum(r.shard == s for r in out) for s in range(8)} == {125}


def test_sharding_cuts_fewer_edges_than_hashing(spark, monkeypatch):
    """Groups of 2 to 12 copies among single texts: few lose a member, where a hash of the row cuts most."""
    r, rows = random.Random(12), []
    for g in range(150):
        rows += [f"group {g}"] * r.randint(2, 12)
    rows += [f"single {i}" for i in range(700)]
    r.shuffle(rows)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)

    def cut(shard_of):
        """Members that are not on the shard of most of their group."""
        on = {}
        for d, t in enumerate(rows):
            on.setdefault(t, []).append(shard_of[d])
        return sum(len(x) - max(map(x.count, x)) for x in on.values())

    for spread in (8000, 300):
        monkeypatch.setattr(sharding, "SPREAD", spread)
        out = {x.doc_id: x.shard for x in sharding.propagate(docs).collect()}
        assert cut(out) <= 0.05 * cut({d: hash((d, "x")) % 8 for d in range(len(rows))})


def test_sharding_plan_fills_to_capacity():
    spots, room = sharding.planned([7, 7, 7, 30], {0: 11, 1: 10, 2: 10, 3: 10, 4: 10, 5: 10})
    assert [len(own) for own in spots] == [1, 1, 1, 3] and sum(n for _, n in spots[3]) == 30
    assert sum(room.values()) == 61 - 51 and min(room.values()) >= 0


def test_surrogates(spark):
    text = "Mail anna.b@mail3.example.com or ANNA.B@mail3.example.com, call +1 (017) 555-7713 or +1 017 555 7713; 10.20.30.44 4111111111111111 token = \"9b0b3c6a43eb78aa99cbd7049c572391524f37a8\"!! Frau Erika Muster, Mr. Smith; 123-45-6789."
    rows = [(1, text), (2, text), (3, None), (4, ""), (5, "no data here 3.1 1999 v4.0."), (6, "Call +1 (017) 555-7713***"), (7, "Herr Smith " + "x" * 50_000 + " 10.20.30.44")]
    made = pii.pseudonymised(frame(spark, rows), "k")
    out = {r.doc_id: r for r in made.collect()}
    assert out[1].text == out[2].text and out[3].text is None and out[4].text == "" and out[5].text == rows[4][1] and out[5].n_entities == 0
    assert (out[1].n_email, out[1].n_phone, out[1].n_ip, out[1].n_number, out[1].n_secret, out[1].n_name, out[1].n_ssn) == (2, 2, 1, 1, 1, 2, 1)
    for private in ("anna.b", "ANNA.B", "555-7713", "10.20.30.44", "4111111111111111", "9b0b3c6a", "Erika", "Muster", "Smith", "123-45-6789"):
        assert private not in out[1].text, private
    assert len(out[1].text.split()) == len(text.split()) and "Frau " in out[1].text and "Mr. " in out[1].text
    phones = [out[1].text.split("call ")[1].split(" or")[0], out[1].text.split(" or ")[2].split(";")[0], out[6].text[5:].rstrip("*")]
    digits = {"".join(c for c in p if c.isdigit()) for p in phones}
    assert len(digits) == 1 and phones[0] == phones[2] and phones[0].startswith("+1 (")
    card = next(w for w in out[1].text.split() if w.isdigit() and len(w) == 16)
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(card)))
    assert total % 10 == 0 and out[7].text.split()[-1] in out[1].text
    assert made.columns.count("n_entities") == 1 and pii.pseudonymised(empty(spark), "k").count() == 0


def test_surrogates_cover_long_entities(spark):
    r = random.Random(6)
    run = lambda n, of="abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789": "".join(r.choice(of) for _ in range(n))
    key, jwt, bare, sk, local, label, name = run(300), f"{run(36)}.{run(700)}.{run(43)}", run(20_000, "0123456789abcdef"), "sk-" + run(120), run(90), run(80), run(50, "abcdefghij")
    texts = [f"token={key} end", f"token: {jwt}. End", f"hash {bare}, end", f"use {sk} end", f"to {local}@{label}.example.com now", f"Mr. B{name} said", "secret = dGhpcyBpcyBhIHNlY3JldA== end", "at " + "a." * 20_000]
    out = {x.doc_id: x for x in pii.pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").collect()}
    for i, whole in enumerate([key, jwt, bare, sk[3:], local, name, "dGhpcyBpcyBhIHNlY3JldA"]):
        assert out[i].n_entities == 1, i
        assert not any(whole[j : j + 12] in out[i].text for j in range(len(whole) - 11)), i
        assert i == 5 or len(out[i].text) == len(texts[i])
    assert out[1].text.endswith(". End") and out[1].text.count(".") == 3 and out[6].text.endswith("== end") and label not in out[4].text
    assert out[7].text == texts[7] and out[7].n_entities == 0


def test_surrogates_stay_distinct_in_a_crowded_space(spark):
    rows = [(i, f"at {i // 100 % 10}.{i // 10 % 10}.1.{i % 10} now") for i in range(0, 1000, 2)]
    out = pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    to = {r.text.split()[1] for r in out}
    assert len(to) == 500 and not to & {t.split()[1] for _, t in rows}


def test_surrogates_stay_distinct_in_an_exhausted_space(spark):
    """Every address of its format is taken, and more than half of the quads: no replacement of that format is free."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    real = [f"{a}@{b}.com" for a in letters for b in letters] + [f"{i // 1000}.{i // 100 % 10}.{i // 10 % 10}.{i % 10}" for i in range(7000)]
    rows = [(i, f"at {e} now") for i, e in enumerate(real)]
    out = pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    to = {r.text.split()[1] for r in out}
    assert len(to) == len(real) and not to & set(real)


def test_html_blocks():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body class="main"><nav><ul><li>Menu</ul></nav>
    <div class="cookie-notice">We use <b>cookies</b></div><article><h1>Head &amp; tail</h1><p>One<br>two <b>three</b>four&nbsp;&#233;<p class='x > y'>five<form>name</form>
    <aside>side</aside><pre> a
     b </pre><section class="comments"><article>reader</article></section><p>last</article><div>after</div><footer>&copy; f</footer>"""
    found = html.blocks(page)
    assert [t for z, t in found if z == html.ARTICLE] == ["Head & tail", "One", "two threefour é", "five", "a b", "last"]
    assert [t for z, t in found if z == html.CHROME] == ["Menu", "We use cookies", "name", "side", "reader", "© f"]
    assert html.blocks("") == [] and html.blocks("<p") == [(0, "<p")] and html.blocks("a < b <!-- x") == [(0, "a < b")]


def test_suffix_ranks_match_sorting():
    r = np.random.RandomState(1)
    ids = r.randint(0, 3, 200).astype(np.uint64)
    rank = html.suffix_ranks(ids, 8)
    keys = [tuple(ids[i : i + 8].tolist()) for i in range(200)]
    order = {k: i for i, k in enumerate(sorted(set(keys)))}
    assert rank.tolist() == [order[k] for k in keys]


def test_html_boilerplate_outside_articles(spark, monkeypatch):
    common = "subscribe to our weekly letter and never miss a single story again"
    pages = [(i, "http://h.example/%d" % i, f"<div>{common}</div><p>unique words of page number {i} are here</p>") for i in range(5)]
    pages += [(7, "http://h.example/7", f"<article><p>{common}</p></article><p>{common}</p>"), (8, None, None), (9, "", ""), (10, "http://o.example/", f"<p>{common}"), (None, "http://h.example/x", "<p>short</p>")]
    for size in (2000, 1):
        html.CHUNK_PAGES, kept = size, html.CHUNK_PAGES
        out = {r.page_id: (r.text, r.n_chars) for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("row", F.lit(0))).collect()}
        html.CHUNK_PAGES = kept
        for i in range(5):
            assert out[i][0] == f"unique words of page number {i} are here"
        assert out[7][0] == out[10][0] == common and out[8] == out[9] == ("", 0) and out[None] == ("short", 5)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_repeats_in_articles_and_runs_outside(spark, monkeypatch):
    """A notice in every article goes, a passage that two of nine articles share stays, and so do runs beside a teaser."""
    notice, passage = "please support our small newsroom with a gift of any size today", "this passage was written once and then quoted by another author"
    card = "<main><article><p>teaser {i}x{i}</p></article><div>the long story {i}a{i} of page {i}b{i} goes on outside</div></main>"
    pages = [(i, f"http://h.example/{i}", f"<article><p>{notice}</p><p>own {i}o{i} text {i}t{i} here</p>{f'<p>{passage}</p>' if i < 2 else ''}</article>") for i in range(9)]
    pages += [(20 + i, f"http://c.example/{i}", card.format(i=i)) for i in range(3)]
    for size in (2000, 1):
        monkeypatch.setattr(html, "CHUNK_PAGES", size)
        out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
        for i in range(9):
            assert out[i] == f"own {i}o{i} text {i}t{i} here" + (f" {passage}" if i < 2 else "")
        for i in range(3):
            assert out[20 + i] == f"teaser {i}x{i} the long story {i}a{i} of page {i}b{i} goes on outside"


def test_html_short_blocks(spark):
    """Menu items, lines of a word or two, and sequences of them go where the host repeats them, cut alike or not."""
    menu = "".join(f"<li>{w}</li>" for w in "home news sport culture travel money weather contact imprint".split())
    flat = "<p>home news sport culture travel</p><p>money weather contact imprint</p>"
    pages = [(i, f"http://h.example/{i}", f"<ul>{menu if i else ''}</ul>{'' if i else flat}<p>unique {i}u{i} words</p><p>Read more</p>") for i in range(3)]
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert out == {i: f"unique {i}u{i} words" for i in range(3)}


def test_surrogates_keep_families_together(spark):
    """Whoever shares a surname still does, whatever the draws; given names are apart from it and match the gender."""
    first = [f"{a}{b}" for a in ("Zan", "Kor", "Lud", "Mir") for b in ("a", "ek", "in", "or", "us", "il")]
    rows = [(0, "Mr Smith met Mrs Smith"), *((1 + i, f"Mr {f} Smith and Mrs {f} Jones") for i, f in enumerate(first)), (90, "Dr Jane Roe, John Smith and Jane Roe; Госпожа Анна Петрова, Госпожа Петрова")]
    out = {r.doc_id: r.text for r in pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    smith, jones = out[0].split()[1], out[1].split()[-1]
    assert out[0].split() == ["Mr", smith, "met", "Mrs", smith] and smith not in ("Smith", jones)
    assert all(out[1 + i].split()[2] == smith and out[1 + i].split()[-1] == jones for i in range(len(first)))
    men, women = ({out[1 + i].split()[j] for i in range(len(first))} for j in (1, 5))
    assert len(men) == len(women) == len(first) and not (men | women) & set(first)
    assert all(any(x.startswith(n) for n in pii.GIVEN["latin", "m"]) for x in men) and all(any(x.startswith(n) for n in pii.GIVEN["latin", "f"]) for x in women)
    doctor, john, jane, anna, petrova = out[90].replace(" and ", ", ").replace("; ", ", ").split(", ")
    assert doctor == f"Dr {jane}" and john.split()[1] == smith and "Roe" not in doctor and "Jane" not in doctor
    assert anna.split()[0] == petrova.split()[0] == "Госпожа" and anna.split()[2] == petrova.split()[1] != "Петрова" and "Анна" not in anna


def test_surrogates_of_further_types(spark):
    texts = ["pay to DE89 3704 0044 0532 0130 00 now", "pay to DE89370400440532013000 now", "host 2001:db8:85a3::8a2e:370:7334 up", "at 221b Baker Street today", "in der Lindenstraße 12 gestern", "at 12:30:45 and std::vector and a: b"]
    out = {r.doc_id: r for r in pii.pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").collect()}
    iban = lambda t: t.removeprefix("pay to ").removesuffix(" now")
    assert iban(out[0].text).replace(" ", "") == iban(out[1].text) != iban(texts[1]) and [len(x) for x in iban(out[0].text).split()] == [4, 4, 4, 4, 4, 2]
    digits = "".join(str(int(c, 36)) for c in iban(out[1].text)[4:] + iban(out[1].text)[:4])
    assert int(digits) % 97 == 1 and iban(out[1].text).startswith("DE")
    assert [(out[i].n_iban, out[i].n_ipv6, out[i].n_street, out[i].n_entities) for i in range(6)] == [(1, 0, 0, 1), (1, 0, 0, 1), (0, 1, 0, 1), (0, 0, 1, 1), (0, 0, 1, 1), (0, 0, 0, 0)]
    assert [len(x) for x in out[2].text.split()[1].split(":")] == [4, 3, 4, 0, 4, 3, 4] and "85a3" not in out[2].text
    assert out[3].text.endswith(" Street today") and "Baker" not in out[3].text and "straße " in out[4].text and "Linden" not in out[4].text and out[5].text == texts[5]


def test_html_equal_pages_keep_their_text(spark):
    page = "<p>one page that was stored two times under one name with all its words</p>"
    rows = [(1, "http://h.example/a", page), (1, "http://h.example/a", page), (2, "http://h.example/b", "<p>other words stand here on this page</p>")]
    out = sorted((r.page_id, r.n_chars) for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert out == [(1, 68), (1, 68), (2, 35)]


def test_html_matches_brute_force(spark, monkeypatch):
    """Random pages of three hosts made of shared and own runs, in one unit a host and in many."""
    r, words = random.Random(21), [f"w{i}" for i in range(400)]
    run = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared, rows = [run(n) for n in (3, 9, 12, 20, 5)], []
    for i in range(60):
        part = lambda: "".join(f"<p>{r.choice(shared) if r.random() < 0.5 else ''} {run(r.randint(0, 14))} {r.choice(shared) if r.random() < 0.2 else ''}</p>" for _ in range(r.randint(0, 4)))
        page = part() + (f"<article>{part()}</article>" if r.random() < 0.7 else "") + f"<nav>{r.choice(shared)}</nav>" + part()
        rows += [(i, f"http://{r.choice('abc')}.example/{i}", page)] * (2 if i % 10 == 0 else 1)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for size, one_in in ((2000, 50), (4, 50), (4, 3)):
        monkeypatch.setattr(html, "CHUNK_PAGES", size)
        monkeypatch.setattr(html, "ONE_IN", one_in)
        want = {d: t for (d, _, _), t in zip(rows, brute.page_texts([(u.split("/")[2], h) for _, u, h in rows], html.blocks, html.LONG, one_in, html.ARTICLE_PAGES), strict=True)}
        out = html.extract(frame).collect()
        assert len(out) == len(rows) and {x.page_id: x.text for x in out} == want, (size, one_in)
