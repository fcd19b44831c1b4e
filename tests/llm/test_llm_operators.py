"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and its defined edge cases."""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from harvest.llm import op01_substring_dedup as op1
from harvest.llm import op02_bpe_lexicon as op2
from harvest.llm import op03_decontaminate as op3
from harvest.llm import op04_suffix_dedup as op4
from harvest.llm import op05_language_id as op5
from harvest.llm import op06_simhash_dedup as op6
from harvest.llm import op07_sharding as op7
from harvest.llm import op08_quality_rules as op8
from harvest.llm import op09_html_text as op9
from harvest.llm import op10_chat_format as op10

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, dk long, text_hash string"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return sorted((r.doc_id, r.text) for r in docs.collect())


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in any column, empty, short, long and repeated texts, repeated rows, columns with clashing names."""
    long = " ".join(f"w{i % 977}é" for i in range(30_000))
    passage = " ".join(f"p{i}" for i in range(60))
    data = [(1, None, "en", 0, "a"), (2, "", None, 0, "b"), (3, " \n\t ", "en", None, None), (4, passage, "en", 1, "c"), (4, passage, "en", 1, "c"),
            (None, passage + " tail", None, 2, "d"), (None, None, None, None, None), (5, "x " + passage, "fr", 3, "e"), (6, long, "en", 4, "f"),
            (7, "ha " * 100, "en", 5, "g"), (8, "one", "de", 6, "h"), (4, "other text of the same id", "en", 7, "i")]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 1 and 4 ------------------------------------------------------------------------------------------------------------

def first_stays(rows, size=20):
    seen, out = set(), {}
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for j in range(len(w) - size + 1):
            k = tuple(w[j:j + size])
            if k in seen:
                gone[j:j + size] = [True] * size
            seen.add(k)
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode()))
    return out


def none_stays(rows, size=200, keep_first=False):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[j:j + size] for _, b in data for j in range(len(b) - size + 1))
    seen, out = set(), {}
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - size + 1):
            k = b[j:j + size]
            if (k in seen) if keep_first else count[k] > 1:
                gone[j:j + size] = True
            seen.add(k)
        out[i] = (len(b), int(gone.sum()), len(op4.runs(gone)), sha(np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("options", [{}, {"hot": 5, "batch_hot": 2, "room": 2000}])
def test_op1_brute_force(docs, rows, options):
    got = {r.doc_id: tuple(r)[1:] for r in op1.digest(op1.substring_dedup(docs, **options)).collect()}
    assert got == first_stays(rows)
    assert sum(x[1] for x in got.values()) > 1000


@pytest.mark.parametrize("options", [{}, {"hot": 5, "batch_hot": 2, "room": 5000}, {"keep_first": True}])
def test_op4_brute_force(docs, rows, options):
    got = {r.doc_id: tuple(r)[1:] for r in op4.digest(op4.suffix_dedup(docs, **options)).collect()}
    assert got == none_stays(rows, keep_first=options.get("keep_first", False))


def test_op1_op4_odd_rows(spark, odd):
    got = sorted((r.id is None, r.id, r.n_words, r.n_removed) for r in op1.substring_dedup(odd).collect())
    assert len(got) == 12 and (False, 4, 60, 0) in got and got.count((False, 4, 60, 0)) == 2       # repeated row: one document
    assert (False, 5, 61, 60) in got and (True, None, 61, 60) in got and (True, None, 0, 0) in got   # null ids come last
    assert (False, 7, 100, 99) in got                                                     # its own earlier copy
    assert (False, 1, 0, 0) in got and (False, 2, 0, 0) in got and (False, 3, 0, 0) in got
    kept = {r.id: r for r in op4.suffix_dedup(odd.where("doc_id in (4, 5, 1)"), size=50).collect()}
    assert kept[1].n_bytes == 0 and kept[5].n_removed > 100
    assert op1.substring_dedup(empty(spark)).count() == 0 and op4.suffix_dedup(empty(spark)).count() == 0


@pytest.mark.parametrize("options", [{}, {"hot": 5, "batch_hot": 2}])
def test_op1_op4_texts_of_one_id(spark, options):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words), " ".join(["x0", *words]), " ".join(words[100:]) + " y"]
    data = spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string")
    order = {r.text: r.th for r in data.selectExpr("text", "xxhash64(text) th").collect()}
    rows = [((k, t), t) for k, t in enumerate(sorted(texts, key=order.get))]
    got = sorted((r.n_words, r.n_removed, r.kept_text) for r in op1.substring_dedup(data, **options).collect())
    assert [(n, g, sha(t.encode())) for n, g, t in got] == sorted(((n, g, h) for n, g, h in first_stays(rows).values()), key=lambda x: x[:2])
    for first in (False, True):
        got = sorted((r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in op4.suffix_dedup(data, keep_first=first, **options).collect())
        assert got == sorted(none_stays(rows, keep_first=first).values())


def test_op1_op4_a_passage_in_a_third_of_the_documents(spark):
    rnd = random.Random(21)
    passage = " ".join(f"shared{k}" for k in range(40))
    rows = [(k, f"start{k} {rnd.random()} " + (passage if k % 3 == 0 else "own " * 3) + f" end{k} {rnd.random()}") for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    options = {"hot": 100, "batch_hot": 60, "room": 20_000}
    got = {r.doc_id: tuple(r)[1:] for r in op1.digest(op1.substring_dedup(docs, **options)).collect()}
    assert got == first_stays(rows) and sum(x[1] for x in got.values()) == 499 * 40
    got = {r.doc_id: tuple(r)[1:] for r in op4.digest(op4.suffix_dedup(docs, **options)).collect()}
    assert got == none_stays(rows)


def test_suffix_ranks_and_factors():
    rnd = random.Random(3)
    for depth in (3, 8, 20, 24, 50):
        data = bytes(rnd.choice(b"ab") for _ in range(400))
        rank = op4.suffix_ranks(np.frombuffer(data, np.uint8), depth)
        keys = [data[i:i + depth].ljust(depth, b"\0") for i in range(len(data))]
        assert [sorted(set(keys)).index(k) for k in keys] == rank.tolist()
        starts = np.arange(len(data) - depth + 1)
        previous, following = op4.factors(np.frombuffer(data, np.uint8), starts, depth)
        assert previous.tolist() == [keys[i] in keys[:i] for i in starts]
        assert following.tolist() == [keys[i] in keys[i + 1:len(starts)] for i in starts]


# 2 ------------------------------------------------------------------------------------------------------------------

def test_op2_against_the_tokenizers_library(docs, rows):
    t = Tokenizer.from_file(PATH)
    got = {r.doc_id: tuple(r)[1:] for r in op2.digest(op2.encode_and_decode(docs)).collect()}
    for i, text in rows:
        ids = t.encode(text, add_special_tokens=False).ids
        assert got[i] == (len(ids), sha(",".join(map(str, ids)).encode()), sha(t.decode(ids, skip_special_tokens=False).encode()))


def test_op2_random_strings(tmp_path):
    t, v = Tokenizer.from_file(PATH), op2.vocabulary(PATH)
    words = sorted({b"the", b" the", b"aaaa", b" hello", b"ha"})
    op2.Lexicon.write(str(tmp_path / "x"), words, v.merged(words))
    e, rnd = op2.Encoder(v, op2.Lexicon(str(tmp_path / "x"))), random.Random(1)
    alphabet = [*"aaabcde's  \n\t0123 ,.!<|>", "<|endoftext|>", "é", "日本", "\U0001F600", "\x00", "\x85", "\xa0", "½", "'re", "haha", " the", "　"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(30))) for _ in range(4000)] + ["<|endof", "text|>", "'", "s", " ", "x", None, ""]
    at_once = e.encode(pa.array(texts)).to_pylist()
    for s, ids in zip(texts, at_once):
        assert ids == t.encode(s or "", add_special_tokens=False).ids
        assert e.encode(pa.array([s])).to_pylist() == [ids]
        assert v.text(np.array(ids, np.int64), np.array([len(ids)])) == [s or ""]


def test_op2_transducer(tmp_path):
    rnd = random.Random(5)
    words = sorted({bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(1, 9))) for _ in range(800)})
    op2.Lexicon.write(str(tmp_path / "x"), words, [np.int32(i).tobytes() for i in range(len(words))])
    lexicon = op2.Lexicon(str(tmp_path / "x"))
    assert lexicon.places(words).tolist() == list(range(len(words)))
    others = [w for w in (bytes(rnd.choice(b"abcd") for _ in range(rnd.randrange(9))) for _ in range(800)) if w not in set(words)]
    assert set(lexicon.places(others).tolist()) == {-1}
    assert len(lexicon.key) < sum(map(len, words)) / 3      # suffixes are shared


def test_op2_decode_alone(docs, rows):
    name = op2.build_lexicon(docs, PATH)
    assert sorted((r.rest.doc_id, r.text) for r in op2.decode(op2.encode(docs, PATH, name), PATH).collect()) == rows


def test_op2_odd_rows(spark, odd):
    got = op2.digest(op2.encode_and_decode(odd)).collect()
    assert len(got) == 12 and {r.n_tokens for r in got if r.decoded_sha256 == sha(b"")} == {0}
    assert op2.encode_and_decode(empty(spark)).count() == 0


# 3 ------------------------------------------------------------------------------------------------------------------

def test_op3_exact_reworked_and_clean(spark):
    item = "A train from Paris to London travels 120 km in 2 hours before noon"
    other = "A train from Rome to Madrid travels 90 km in 3 hours before noon"
    mixed = "A train from Rome to Rome travels 90 km in 90 hours before noon"
    docs = spark.createDataFrame([(1, "Some words before. " + item + " and more after it"), (2, other), (3, mixed), (4, "a clean text about a train and a signal"),
                                  (5, None), (6, ""), (7, item.upper()), (None, item), (1, "clean"), (2, other)], "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (9, item), (11, None), (12, "Blue whales sing")], "item_id long, text string")
    got = sorted((r.rest.doc_id is None, r.rest.doc_id or 0, r.contaminated, r.kind or "", r["items"] or []) for r in op3.decontaminate(docs, bench).collect())
    assert got == [(False, 1, False, "", []), (False, 1, True, "exact", [9]), (False, 2, True, "reworked", [9]), (False, 2, True, "reworked", [9]),
                   (False, 3, False, "", []), (False, 4, False, "", []), (False, 5, False, "", []), (False, 6, False, "", []),
                   (False, 7, True, "exact", [9]), (True, 0, True, "exact", [9])]
    assert op3.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
    assert op3.decontaminate(docs.limit(0), bench).count() == 0


def test_op3_copies_of_little_but_slots(spark):
    items = ["What is 12 * 7 - 3 * 4 + 9?", "Which of Paris, Rome, Oslo, Bern, Kyiv, Prague is largest", "Wie weit fährt der Zug von Bonn nach Köln am Tag der Ankunft von Peter und Anna in Ulm"]
    docs = spark.createDataFrame([*((k, f"Some words, then: {x} And some more") for k, x in enumerate(items)), (3, "What is 1 * 2 - 3 * 4 + 5?"), (4, "of Lyon, Rome, Nice, Bern, Metz, Prague is largest")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.rest.doc_id: (r.kind, r["items"]) for r in op3.decontaminate(docs, bench).collect()}
    assert got == {0: ("exact", [0]), 1: ("exact", [1]), 2: ("exact", [2]), 3: (None, None), 4: (None, None)}


def test_op3_values_of_other_lengths(spark):
    items = ["A train goes from New York to Paris and takes 1 500 passengers over 5km of track", "Maria has three apples and gives two of them to Peter and then Maria sleeps",
             " ".join(f"w{x}" for x in "abcdefghijklmnopqrstuvwxyz")]
    docs = spark.createDataFrame([(0, "A train goes from Boston to Los Angeles and takes 20 passengers over 7km of track"),
                                  (1, "Anna has four apples and gives five of them to Paul and then Anna sleeps"),
                                  (2, items[2].replace("wj", "extra wj").replace("wr", "two more wr")),
                                  (3, "A train goes from Boston to Boston and takes 20 passengers over 20km of track")], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r.rest.doc_id: (r.kind, r["items"]) for r in op3.decontaminate(docs, bench).collect()}
    assert got[0] == ("reworked", [0]) and got[1] == ("reworked", [1]) and got[2][1] == [2] and got[3] == (None, None)


def test_op3_finds_all_planted_passages(spark, docs, rows):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: " ".join(r.text.lower().split()) for r in bench.collect()}
    expected = {i for i, t in rows if any(x in " ".join(t.lower().split()) for x in items.values())}
    got = {r.doc_id for r in op3.digest(op3.decontaminate(docs, bench)).where("contaminated").collect()}
    assert expected and expected <= got and len(got) <= len(expected) + 2


def test_op3_short_items_match_whole_documents_only(spark):
    bench = spark.createDataFrame([(0, "Paris"), (1, "Yes"), (2, "Who wrote Faust?"), (3, "The answer is of course")], "item_id long, text string")
    docs = spark.createDataFrame([(0, "The answer is Paris of course"), (1, "yes we can"), (2, "PARIS!"), (3, "who wrote faust"), (4, "Who wrote Faust? Goethe"), (5, "Yes")], "doc_id long, text string")
    got = {r.rest.doc_id: (r.kind, r["items"]) for r in op3.decontaminate(docs, bench).where("contaminated").collect()}
    assert got == {2: ("exact", [0]), 3: ("exact", [2]), 5: ("exact", [1])}


def slow_windows(text, size=8):
    lexer = op3.Lexer()
    words, _, _, kind = lexer.read(text)
    if not words:
        return 0, [], []
    first = op3.slots_of(kind)
    k, w = min(size, len(first) - 1), min(size, len(words))
    every = lambda n: list(range(n))
    tokens = {n: list(op3.templates(words, kind, first, n, every(len(first) - n))) for n in range(1, k + 1)}
    plain = {n: [x for x in op3.literals(words, first, n, every(len(words) - n + 1)) if kind[x[1]:x[2]].any()] for n in range(1, w + 1)}
    return len(words), tokens, plain


def slow_contamination(text, items, coverage=0.5):
    """The items that a document holds, comparing each window of each item with each of the document."""
    from collections import defaultdict
    n_words, tokens, plain = slow_windows(text)
    out = set()
    for item, t in items:
        n, own, literal = slow_windows(t)
        if not n or not n_words or (n_words != n if n < op3.SHORT else n_words < op3.SHORT):
            continue
        k, w = max(own), max(literal)
        good = [x for x in own[k] if 2 * sum(not y.startswith("<") or y not in ("<1>", "<2>", "<3>") for y in x[3]) >= min(x[2] - x[1], max(k, 8))]
        pairs = [(x, y) for x in good for y in tokens.get(k, ()) if x[3] == y[3]]
        pairs += [(x, y) for x in literal[w] for y in [*plain.get(w, ()), *tokens.get(w, ())] if x[3] == y[3]]
        groups = defaultdict(list)
        for x, y in pairs:
            o = y[0] - x[0]
            row = {"item_pos": x[0], "pos": y[0], "begin": x[1], "end": x[2], "item_slots": x[4], "slots": y[4]}
            for near in (2 * (o // op3.DRIFT), 2 * ((o + op3.DRIFT // 2) // op3.DRIFT) + 1):
                if row not in groups[near]:
                    groups[near].append(row)
        if any(op3.best(g, n)[0] >= coverage * n for g in groups.values()):
            out.add(item)
    return out


def test_op3_brute_force_and_recall_of_reworked_items(spark):
    rnd = random.Random(12)
    names = "Maria Peter Anna Paul Olga Ivan Lucia Marco Emma Noah Sofia Hugo".split()
    cities = "Paris Rome Oslo Bern Kyiv Prague Madrid Vienna Dublin Athens Lisbon Warsaw".split()
    templates = ["In the market {a} bought {x} kg of apples and {b} bought {y} kg more, how many kilograms did they carry home together",
                 "A train leaves {c} at {x} and reaches {d} after {y} hours, at what time of the day does it arrive there",
                 "{a} has {x} coins and gives {y} of them to {b} who already owned a small number, how many coins are left",
                 "The distance between {c} and {d} is {x} km and a car needs {y} l of fuel for it, what does the whole trip cost",
                 "If {x} workers need {y} days to build a wall in {c} then how long would twice as many workers need for it"]

    def made(t):
        a, b = rnd.sample(names, 2)
        c, d = rnd.sample(cities, 2)
        x, y = rnd.sample(range(11, 99), 2)
        return t.format(a=a, b=b, c=c, d=d, x=x, y=y)

    filler = lambda: " ".join(rnd.choice("some other words that stand around it in a text about nothing much".split()) for _ in range(30))
    items = [(k, made(t)) for k, t in enumerate(templates)]
    docs = [(k, f"{filler()}. {made(templates[k % 5])}? {filler()}") for k in range(100)] + [(100 + k, filler()) for k in range(40)]
    swapped = [(200, "In the market Maria bought 12 kg of apples and Maria bought 12 kg more, how many kilograms did they carry home together"),
               (201, "In the market Maria bought seven kg of pears while others slept"), (202, None), (203, "12 34 56"), (204, items[0][1])]
    frame = spark.createDataFrame(docs + swapped, "doc_id long, text string")
    got = {r.rest.doc_id: set(r["items"] or ()) for r in op3.decontaminate(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {k: slow_contamination(t, items) for k, t in docs + swapped}
    assert sum(k % 5 in got[k] for k in range(100)) >= 90 and not any(got[100 + k] for k in range(40)) and got[204] == {0} and not got[201]


def test_op3_odd_rows(spark, odd):
    long = " ".join(f"w{i % 977}é" for i in range(500, 540))
    bench = spark.createDataFrame([(None, long, 1), (3, long, 2), (4, None, 3), (5, "", 4)], "item_id long, text string, dk long")
    got = op3.decontaminate(odd.withColumn("item", odd["doc_id"]).withColumn("kind", odd["lang"]), bench).collect()
    assert len(got) == 12 and [(r.rest.doc_id, r["items"]) for r in got if r.contaminated] == [(6, [3])]


# 5 ------------------------------------------------------------------------------------------------------------------

def test_op5_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = op5.fit(docs, ~op5.held_out())
    got = op5.digest(op5.identify(docs, model)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    lang, score, rejected = model.predict([None, "", "12 34 !?", "жизнь и судьба ещё раз приходит", "the and of thing with this"])
    assert lang[:3] == ["und"] * 3 and rejected.tolist()[:4] == [True] * 4 and not rejected[4] and lang[4] == "en" and (score >= 0).all() and (score <= 1).all()


@pytest.mark.parametrize("other", ["de", "en", "es", "fr"])
def test_op5_rejects_a_language_it_has_not_learned(spark, other):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    model = op5.fit(docs, ~op5.held_out() & (docs.lang != other))
    rejected = lambda texts: float(model.predict(texts)[2].mean())
    texts = {held: [r.text for r in docs.where(docs.lang == other if held else (docs.lang != other) & op5.held_out()).collect()] for held in (True, False)}
    assert rejected(texts[True]) > 0.9 and rejected(texts[False]) < 0.02
    for n in (5, 20):
        assert rejected([" ".join(w[10:10 + n]) for w in map(str.split, texts[False]) if len(w) >= 10 + n]) < 0.04


def test_op5_odd_rows(spark, odd):
    assert {r.lang_pred for r in op5.with_language(odd).where("text is null or trim(text) = ''").collect()} == {"und"}
    got = op5.with_language(odd.withColumn("lang", odd.lang.substr(9, 2)).where("false"))
    assert got.count() == 0
    nothing = op5.identify(odd, op5.fit(odd.where("false"), ~op5.held_out()))
    assert {(r.lang_pred, r.rejected) for r in nothing.collect()} == {("und", True)}


def test_op5_small_languages_are_learned(spark):
    """Forty languages of many texts and one of five: it is in the sample whatever the hashes say."""
    rnd = random.Random(17)
    letters = [chr(0x400 + k) for k in range(200)]
    rows = []
    for l in range(41):
        own = letters[l * 4:l * 4 + 8]
        rows += [(len(rows) + k, " ".join("".join(rnd.choices(own, k=5)) for _ in range(12)), f"l{l:02d}") for k in range(5 if l == 40 else 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = op5.fit(docs, docs["doc_id"] >= 0, most=400)
    assert set(model.languages) == {f"l{l:02d}" for l in range(41)}
    found = op5.identify(docs.where("lang = 'l40'"), model).collect()
    assert {r.lang_pred for r in found} == {"l40"}


# 6 ------------------------------------------------------------------------------------------------------------------

def slow_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(3, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[j:j + k]).encode(), 42) for j in range(len(w) - k + 1)] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("tree", [4096, 2])
def test_op6_brute_force(docs, rows, tree, monkeypatch):
    monkeypatch.setattr(op6, "SLICE", 1)
    fp = {i: slow_fingerprint(t) for i, t in rows}
    least = {i: i for i in fp}
    for _ in range(10):
        for a in fp:
            for b in fp:
                if (fp[a] ^ fp[b]).bit_count() <= 2:
                    least[a] = least[b] = min(least[a], least[b])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op6.digest(op6.simhash_dedup(docs, tree=tree)).collect()}
    assert got == {i: (f"{fp[i]:016x}", least[i]) for i in fp}


def test_op6_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (200, 200)]
    got = {r.node: r.root for r in op6.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_op6_forest_finds_all_neighbours():
    rnd = np.random.default_rng(0)
    fp = np.unique((rnd.integers(0, 64, 400).astype(np.uint64) << np.uint64(40)) | rnd.integers(0, 64, 400).astype(np.uint64))
    forest = op6.Forest(fp, np.zeros(len(fp), np.int64))
    found = {(int(a), int(b)) for q, n in forest.search(fp, np.zeros(len(fp), np.int64), 2) for a, b in zip(q, n)}
    assert found == {(a, b) for a in range(len(fp)) for b in range(len(fp)) if int(fp[a] ^ fp[b]).bit_count() <= 2}


def test_op6_odd_rows(spark, odd):
    got = op6.digest(op6.simhash_dedup(odd)).collect()
    none = {r.component_id for r in got if r.fingerprint == "0" * 16}
    assert len(got) == 12 and none == {1}       # null and empty texts are one component
    kept = op6.one_of_each(odd).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept)[0] == (False, 1) and len([r for r in kept if r.doc_id == 4]) == 2
    assert op6.simhash_dedup(empty(spark)).count() == 0


# 7 ------------------------------------------------------------------------------------------------------------------

def test_op7_law_slots_and_sizes(spark, docs, rows, tmp_path):
    got = op7.digest(op7.shuffled(docs, rows_each=10)).collect()
    text = dict(rows)
    assert sorted(r.doc_id for r in got) == sorted(text)
    for r in got:
        data = text[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data)) and r.grown_shard in (r.shard, 8)
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    again = {r.doc_id: r.shard for r in op7.shuffled(docs.repartition(3), rows_each=10).select("rest.doc_id", "shard", "bucket").collect()}
    assert again == {r.doc_id: r.shard for r in got}
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order != sorted(order)
    op7.write(docs, str(tmp_path / "out"), rows_each=50)
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 8


def test_op7_odd_rows(spark, odd):
    got = op7.digest(op7.shuffled(odd)).collect()
    assert len(got) == 12 and {r.size for r in got if r.text_crc32 == 0} == {1}
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert op7.shuffled(empty(spark)).count() == 0
    assert "Python" not in op7.shuffled(odd)._jdf.queryExecution().executedPlan().toString()


# 8 ------------------------------------------------------------------------------------------------------------------

def test_op8_facts_brute_force(docs, rows):
    got = {r.rest.doc_id: tuple(r[f] for f in op8.FACTS) for r in op8.facts(docs).collect()}
    for i, text in rows:
        w = WORD.findall(text)
        c, mark, lines = Counter(tuple(w[j:j + 5]) for j in range(len(w) - 4)), [0] * len(w), [x for x in text.split("\n") if WORD.search(x)]
        for j in range(len(w) - 4):
            if c[tuple(w[j:j + 5])] > 1:
                mark[j:j + 5] = [1] * 5
        assert got[i] == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(mark))


def test_op8_exact_bounds():
    for k, n, error in ((0, 50, 0.05), (3, 80, 0.01), (40, 80, 0.2)):
        p = op8.upper_bound(k, n, error)
        assert math.isclose(sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)), error, rel_tol=1e-6)
    assert op8.upper_bound(5, 5, 0.05) == 1


def test_op8_keeps_good_and_limits_risk(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = op8.digest(op8.quality(docs, labels)).join(labels, "doc_id").collect()
    good = [r.kept for r in got if r.quality == 1 and not r.base_failed]
    assert sum(good) / len(good) > 0.97
    assert sum(r.kept for r in got if r.quality == 0) < 0.4 * sum(r.quality == 0 for r in got)


def test_op8_rules_fire_in_small_strata(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = op8.digest(op8.quality(docs, labels)).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    for lang in ("en", "de", "fr", "es"):
        good, bad = ([r.kept for r in got if r.lang == lang and r.quality == q and not (q and r.base_failed)] for q in (1, 0))
        print(lang, len(good), 1 - sum(good) / len(good), len(bad), sum(bad))
        assert sum(good) / len(good) > 0.97 and sum(bad) < 0.25 * len(bad)


def test_op8_cutoffs_in_fixed_sequence():
    tests = [(rule, c) for rule, (_, _, candidates) in op8.RULES.items() for c in candidates]
    counts = lambda n, bad: {"n": n, **{f"t{i}": n if k else 0 for i, k in enumerate(bad)}, **{f"b{i}": 1 for i in range(len(tests))}}
    none, first = [False] * len(tests), [c == op8.RULES[r][2][-1] for r, c in tests]
    strictest = {r: op8.RULES[r][2][0] for r in op8.RULES}
    assert op8.cutoffs(counts(5000, none), tests, 0.03, 1e-4) == strictest
    assert len(op8.cutoffs(counts(500, none), tests, 0.03, 1e-4)) == 1      # one rule gets the whole risk
    assert op8.cutoffs(counts(5000, first), tests, 0.03, 1e-4) == {} == op8.cutoffs(counts(100, none), tests, 0.03, 1e-4)


def test_op8_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, None), (4, None, 0), (None, 1, 0), (4, 1, 1), (4, 0, 1)], "doc_id long, quality int, toxic int")
    got = op8.digest(op8.quality(odd, labels)).collect()
    assert len(got) == 12 and all(r.base_failed and not r.kept for r in got if r.n_words < 10) and all(r.kept != r.base_failed for r in got)
    assert op8.quality(empty(spark), labels.limit(0)).count() == 0


# 9 ------------------------------------------------------------------------------------------------------------------

def test_op9_longest_common_subsequence():
    rnd = random.Random(2)
    for _ in range(300):
        a, b = ([rnd.choice("abcd") for _ in range(rnd.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found, rest = op9.shared(a, b), iter(b)
        assert len(found) == table[-1][-1] and all(a[i] in rest for i in sorted(found))


def test_op9_long_line_lists(monkeypatch):
    """Alignments beyond CELLS are halved: as long as those that are kept whole; memory stays linear."""
    import tracemalloc
    rnd = random.Random(5)
    for n in (1, 7, 60, 300):
        a, b = ([rnd.choice("abcdefgh") for _ in range(n + rnd.randrange(9))] for _ in range(2))
        whole = op9.subsequence(a, b)
        with monkeypatch.context() as m:
            m.setattr(op9, "CELLS", 20)
            found, rest = op9.subsequence(a, b), iter(b)
        assert len(found) == len(whole) and found == sorted(found) and all(a[i] in rest for i in found)
    a, b = list(range(100_000)), [x for x in range(100_000) if x % 3] + [-1]
    rnd.shuffle(b)
    tracemalloc.start()
    found = op9.shared(a[:30_000] + a, a[:20_000] + b)
    assert tracemalloc.get_traced_memory()[1] < 300e6 and len(found) >= 20_000
    tracemalloc.stop()


def slow_blocks(html):
    """The blocks of well-formed pages by the standard library's parser."""
    from html.parser import HTMLParser
    out, text, stack = [], [], []

    class P(HTMLParser):
        def end(self):
            line = " ".join("".join(text).split())
            if line:
                out.append(line)
            text.clear()

        def handle_starttag(self, tag, attrs):
            if tag == "br":
                text.append(" ")
                return
            if tag not in op9.INLINE:
                self.end()
            if tag not in op9.VOID:
                stack.append((tag, tag in op9.SKIPPED or tag in ("nav", "footer", "aside") or dict(attrs).get("class") in ("ad", "comments", "cookie-notice")))

        def handle_endtag(self, tag):
            if tag not in op9.INLINE:
                self.end()
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass

        def handle_data(self, data):
            if not any(x for _, x in stack):
                text.append(data)

    p = P(convert_charrefs=True)
    p.feed(html)
    p.close()
    p.end()
    return out


def test_op9_extraction_against_a_parser(spark):
    """Pages alone on their host: all blocks but those of boilerplate elements; generated pages and the table's."""
    rnd = random.Random(11)

    def element(depth):
        kind = rnd.choice(["p", "div", "section", "ul", "b", "span", "nav", "aside", "ad", "script", "text", "text", "void", "comment"])
        inner = "".join(element(depth - 1) for _ in range(rnd.randrange(4))) if depth else rnd.choice(["x", "A &amp; B", "&lt;p&gt;", " a\n b ", "it's", "1 < 2"])
        return {"text": rnd.choice(["words ", "&eacute;t&#233; ", "5 &gt; 3 "]), "void": rnd.choice(["<br>", "<img alt='a>b'>", "<hr/>"]), "comment": "<!-- <p>no</p> -->",
                "script": "<script>if (a < b) { '</p>' }</script>", "ad": f'<div class="ad">{inner}</div>'}.get(kind) or f'<{kind} id="k{rnd.randrange(9)}">{inner}</{kind}>'

    pages = ["".join(element(3) for _ in range(6)) for _ in range(60)]
    rows = spark.createDataFrame([(k, f"http://h{k}.example/x", h, "n", "t") for k, h in enumerate(pages)], "page_id long, url string, html string, text string, host string")
    got = {r.page_id: r.text for r in op9.digest(op9.extract(rows)).collect()}
    assert got == {k: "\n\n".join(slow_blocks(h)) for k, h in enumerate(pages)}


def test_op9_titles_marks_and_broken_tags():
    text = lambda html: [t for p, t in op9.blocks(html) if p != op9.SITE]
    assert text("<article><header><h1>Title</h1></header><p>a</p></article><header>Site</header>") == ["Title", "a"]
    assert text('<div class="share-price-table">p</div><p class="ad-hoc-report">q</p><div class="cookie-notice">n</div><div class="site-footer">f</div><div class="x ad">a</div>') == ["p", "q"]
    assert text("<p data=it's>Hello</p><p>World's end</p>") == ["Hello", "World's end"]
    assert text('<p title="a>b" data-x=\'"\'>one</p><p>two') == ["one", "two"]
    assert text("<p>a<b <i>c</i></p><p>d <e") == ["ac", "d"]          # an unclosed tag ends where the next begins, or with the page
    for bad in ("<a " * 350_000, '<a href="' * 120_000, "<div>" * 200_000, "</p>" * 250_000, "<div>" * 100_000 + "</p>" * 100_000, "<!--" * 250_000, "<![CDATA[" * 110_000, "<" * 1_000_000, "<script>" * 120_000, "='" * 400_000,
                "<p x='" + "=\"" * 300_000):
        begin = time.process_time()
        op9.blocks(bad)
        assert time.process_time() - begin < 3


def test_op9_a_sentence_of_one_neighbour_stays(spark):
    """Inside the main element, one page that shares a block is no witness; most of the near pages are."""
    body = [f"Body {k} with its own words" for k in range(7)]
    page = lambda k, extra: f"<article><p>{body[k]}</p><p>Subscribe now</p>{extra}</article>"
    rows = [(k, f"http://h.example/a/{k}", page(k, "<p>A common sentence</p>" if k in (2, 3) else "")) for k in range(7)]
    rows += [(10, "http://two.example/a", "<article><p>One</p><p>Same</p></article>"), (11, "http://two.example/b", "<article><p>Two</p><p>Same</p></article>")]
    got = {r.page_id: r.text for r in op9.digest(op9.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()}
    assert got == {**{k: body[k] + ("\n\nA common sentence" if k in (2, 3) else "") for k in range(7)}, 10: "One\n\nSame", 11: "Two\n\nSame"}


def test_op9_odd_rows(spark):
    long = "<p>" + "</p><p>".join(f"line {k}" for k in range(20_000)) + "</p>"
    rows = [(1, "http://h.example/a", long, "x"), (1, "http://h.example/a", long, "x"), (None, None, None, None), (2, "http://h.example/b", long + "<p>more</p>", None), (3, "no url", "<p>t</p>", "y")]
    got = op9.digest(op9.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))).collect()
    assert sorted((r.page_id is None, r.page_id, r.n_chars) for r in got)[:2] == [(False, 1, sum(len(f"line {k}") for k in range(20_000)) + 2 * 19_999)] * 2
    assert {(r.page_id, r.text) for r in got if r.page_id in (None, 3)} == {(None, ""), (3, "t")}


def test_op9_articles_and_differences(spark):
    page = "<html><body><nav>Menu</nav><p>Site line</p><div class='cookie-notice'>We use</div><p>Body of {0} &amp; more<br>text</p><script>x<p></script><p>Last line</p></body>"
    rows = [(1, "http://h.example/a/1", page.format("one")), (2, "http://h.example/a/2", page.format("two")), (3, "http://other.example/a/1", page.format("three")),
            (4, "http://h.example/b", "<article><h1>T</h1><p>same</p><div class=comments><p>hi</p></div></article><footer>f</footer>"),
            (5, "http://h.example/c", "<article><h1>T</h1><p>same</p></article><aside>x</aside>"), (6, None, None), (None, "::", ""), (7, "http://h.example/d", "<b>a</b> &lt;b&gt;")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in op9.digest(op9.extract(pages)).collect()}
    assert got == {1: "Body of one & more text", 2: "Body of two & more text", 3: "Site line\n\nBody of three & more text\n\nLast line", 4: "T\n\nsame", 5: "T\n\nsame",
                   6: "", None: "", 7: "a <b>"}
    assert op9.extract(pages.limit(0)).count() == 0


def test_op9_differencing_decides_inside_and_outside(spark):
    page = "<p>Teaser of {0}</p><main><p>Subscribe to us</p><p>Body of {0}</p></main><p>Site line</p>"
    pages = spark.createDataFrame([(k, f"http://h.example/a/{k}", page.format(w)) for k, w in enumerate(("one", "two", "three"))], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in op9.digest(op9.extract(pages)).collect()}
    assert got == {k: f"Teaser of {w}\n\nBody of {w}" for k, w in enumerate(("one", "two", "three"))}


def test_op9_copies_do_not_empty_each_other(spark):
    page = "<p>Site line</p><p>A body that is about {0} and goes on for a while, as it has much to say about {0}</p><p>{1}</p><p>Last line</p>"
    rows = [*((k, f"http://h.example/a/1?utm_source={k}", page.format("one", "")) for k in range(40)), (40, "http://h.example/a/1/print", page.format("one", "Print")),
            (41, "http://h.example/b/2", page.format("two", "")), (42, "http://alone.example/x", page.format("one", "")), (43, "http://alone.example/y", page.format("one", ""))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in op9.digest(op9.extract(pages)).collect()}
    body = "A body that is about {0} and goes on for a while, as it has much to say about {0}"
    assert {got[k] for k in range(40)} == {body.format("one")} and got[40] == body.format("one") + "\n\nPrint" and got[41] == body.format("two")
    assert got[42] == got[43] == f"Site line\n\n{body.format('one')}\n\nLast line"


# 10 -----------------------------------------------------------------------------------------------------------------

def test_op10_links_order_and_errors(spark):
    n = None
    rows = [(1, 0, "user", "hi", n, n, n), (1, 5, "assistant", n, "a", "lookup", '{"query":"x","limit":1}'), (1, 4, "tool", "r1", "a", n, n),
            (1, 2, "assistant", n, "b", "lookup", '{"limit": "many", "query":"$a"}'), (1, 6, "tool", "r2", "b", n, n), (1, 7, "tool", "?", "z", n, n),
            (1, 8, "assistant", n, "c", "nope", "{}"), (1, 9, "assistant", n, "a", "lookup", "[1]"), (1, 9, "assistant", n, "a", "lookup", "[1]"),
            (2, 1, "assistant", n, "p", "lookup", '{"query":"$q"}'), (2, 2, "assistant", n, "q", "lookup", '{"query":"$p"}'), (2, 3, "tool", "1", "p", n, n),
            (2, 4, "tool", "2", "q", n, n), (n, n, n, n, n, n, n)]
    events = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, call_id string, name string, arguments string")
    out = op10.format_chat(events, op10.tool_table(spark))
    got = {(r.conv_id, r.place): r for r in out.collect()}
    one = [got[1, k] for k in range(1, 9)]
    assert [(r.turn, r.status, r.level) for r in one] == [(0, "message", 0), (5, "call", 0), (4, "result", 1), (2, "call", 2), (6, "result", 3), (7, "orphan", 0),
                                                          (8, "pending", 0), (9, "duplicate", 0)]
    assert one[1].errors == [] and one[3].errors == ["type limit"] and one[6].errors == ["unknown tool"] and one[7].errors == ["not an object"] and one[7].copies == 2
    assert one[1].json == '{"arguments":{"limit":1,"query":"x"},"call_id":"a","errors":[],"name":"lookup","role":"assistant","status":"call","turn":5}'
    assert {got[2, k].status for k in range(1, 5)} == {"cyclic"} and got[None, 1].status == "message"
    assert all(list(json.loads(r.json)) == sorted(json.loads(r.json)) for r in got.values())
    assert op10.format_chat(events.limit(0), op10.tool_table(spark)).count() == 0


def slow_chat(events, tools):
    """(conv, place, turn, status, level, errors) of each distinct event, by plain loops."""
    spec = {}
    for name, param, kind, required in tools:
        spec.setdefault(name, {})[param] = (kind, required)
    fits = {"string": lambda v: isinstance(v, str), "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
            "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool), "boolean": lambda v: isinstance(v, bool),
            "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list)}
    out = []
    late = lambda t: op10.LAST if t is None else t
    for conv in {e[0] for e in events}:
        own = sorted({e for e in events if e[0] == conv}, key=repr)
        calls, results = {}, {}
        for e in sorted(own, key=lambda e: late(e[1])):
            if e[4] is not None:
                if e[5] is not None:
                    calls.setdefault(e[4], e)
                elif e[2] == "tool":
                    results.setdefault(e[4], e)
        status, errors, needs = {}, {}, {e: set() for e in own}
        for e in own:
            if e[5] is not None:
                status[e] = "pending" if e[4] is None else "duplicate" if calls[e[4]] != e else "call" if e[4] in results else "pending"
                try:
                    given = json.loads(e[6]) if e[6] is not None else None
                except ValueError:
                    given = None
                refs = {k: v[1:] for k, v in given.items() if isinstance(v, str) and v.startswith("$")} if isinstance(given, dict) else {}
                if e[5] not in spec:
                    found = ["unknown tool"]
                elif not isinstance(given, dict):
                    found = ["not an object"]
                else:
                    s = spec[e[5]]
                    found = [f"unknown {k}" for k in given if k not in s] + [f"type {k}" for k, v in given.items() if k in s and k not in refs and not fits[s[k][0]](v)]
                    found += [f"missing {k}" for k, (_, required) in s.items() if required and k not in given]
                errors[e] = sorted(found + [f"unresolved {k}" for k, r in refs.items() if r not in calls])
                needs[e] = {results[r] for r in refs.values() if r in results and r in calls}
            elif e[2] == "tool":
                status[e] = "orphan" if e[4] not in calls or e[4] is None else "duplicate" if results[e[4]] != e else "result"
                if status[e] == "result":
                    needs[e] = {calls[e[4]]}
            else:
                status[e] = "message"
        level, due = {}, {}
        while True:
            ready = [e for e in own if e not in level and all(x in level for x in needs[e])]
            if not ready:
                break
            for e in ready:
                level[e] = max((level[x] + 1 for x in needs[e]), default=0)
                due[e] = max([late(e[1]), *(due[x] for x in needs[e])])
        for e in own:
            if e not in level:
                status[e] = "cyclic"
        order = sorted(own, key=lambda e: (due.get(e, late(e[1])), level.get(e, 0), late(e[1])))
        out += [(conv, k + 1, e[1], e[4], status[e], level.get(e), errors.get(e)) for k, e in enumerate(order)]
    return out


def test_op10_brute_force(spark):
    rnd = random.Random(31)
    tools = [tuple(r) for r in op10.tool_table(spark).collect()] + [("deep", "flag", "boolean", True), ("deep", "list", "array", False), ("deep", "more", "object", False)]
    value = lambda: rnd.choice(['"x"', "3", "2.5", "true", "null", "[1]", '{"a":1}', '"$a"', '"$b"', '"$c"', '"$5"', '"$"', '"' + "long " * 2000 + '"'])
    events, turn = [], 0
    for conv in [*range(12), None]:
        for _ in range(14):
            turn += rnd.choice([1, 3])          # turns do not tie, so places are determined
            kind = rnd.choice(["call", "call", "tool", "user"])
            call = rnd.choice(["a", "b", "c", "d", None])
            if kind == "call":
                args = rnd.choice([None, "no json", "[1]"]) if rnd.random() < 0.1 else "{" + ",".join(f'"{k}":{value()}' for k in rnd.sample(["query", "limit", "after", "flag", "list", "more", "odd"], rnd.randrange(4))) + "}"
                events.append((conv, turn, "assistant", None, call, rnd.choice(["lookup", "deep", "none"]), args))
            else:
                events.append((conv, turn, kind, rnd.choice(["t", "", None]), call if kind == "tool" else None, None, None))
    events += events[:5]
    schema = "conv_id long, turn long, role string, text string, call_id string, name string, arguments string"
    rows = spark.createDataFrame([(*e, "x", 1) for e in events], schema + ", status string, level int")
    got = op10.format_chat(rows, spark.createDataFrame(tools, "name string, param string, type string, required boolean")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.conv_id, r.place, r.turn, r.call_id, r.status, r.level, r.errors) for r in got), key=key) == sorted(slow_chat(events, tools), key=key)
    assert {"call", "pending", "result", "orphan", "duplicate", "cyclic", "message"} <= {r.status for r in got} | {"cyclic"} and any("unresolved limit" in (r.errors or ()) for r in got)
    none = op10.format_chat(rows, spark.createDataFrame([], "name string, param string, type string, required boolean")).where("errors is not null").collect()
    assert none and all("unknown tool" in r.errors for r in none)


def test_op10_over_the_table(spark):
    c = spark.read.parquet(f"{SF}/conversations.parquet")
    got = op10.format_chat(op10.tool_use(c), op10.tool_table(spark)).collect()
    place = {(r.conv_id, r.call_id, r.status): r.place for r in got if r.status in ("call", "result")}
    assert len(got) == sum(1 + 2 * (r.role == "assistant") for r in c.collect()) and place
    assert all(place[k[0], k[1], "call"] < p for k, p in place.items() if k[2] == "result")
