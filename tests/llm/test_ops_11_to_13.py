"""URL filter, whitening and Merkle manifest against brute-force versions, and their defined edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from harvest.llm import op11_url_filter as op11
from harvest.llm import op12_whitening as op12
from harvest.llm import op13_merkle_manifest as op13

SF = "/root/testdata/sf0.001"


# 11 -----------------------------------------------------------------------------------------------------------------

def slow_address(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def slow_rule(host, path, rules):
    fits = []
    for verdict, rule in rules:
        rh, slash, rest = rule.partition("/")
        if (host == rh or host.endswith("." + rh)) and path.startswith(slash + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def slow_filter(urls, rules=op11.RULES, order=op11.ORDER, least=op11.LEAST, grid=op11.GRID):
    """{url: (host, path, rule, verdict, score)}."""
    parts = {u: slow_address(u) for u in urls}
    label = {a: slow_rule(*a, rules) for a in set(parts.values())}
    held = {a: hashlib.md5("".join(a).encode()).hexdigest()[0] in op11.HELD_OUT for a in label}
    counts = {k: Counter() for k in ("allow", "block")}
    places = {}
    for a in label:
        text = op11.START * order + "".join(a) + op11.END
        places[a] = [text[i:i + order + 1] for i in range(len(text) - order)]
        if label[a][1] and not held[a]:
            for w in places[a]:
                for k in range(order + 1):
                    counts[label[a][1]][w[order - k:]] += 1
    known = {w for c in counts.values() for w in c if len(w) == 1}

    followers = {k: defaultdict(Counter) for k in counts}
    for k, c in counts.items():
        for w, n in c.items():
            followers[k][w[:-1], len(w)][w[-1]] += n

    def chance(k, w):
        if not w:
            return 1 / (len(known) + 1)
        after, shorter = followers[k][w[:-1], len(w)], chance(k, w[1:] if len(w) > 1 else "")
        total = sum(after.values())
        if total < (least if len(w) > 1 else 1):
            return shorter
        return (after[w[-1]] + len(after) * shorter) / (total + len(after))

    score = {a: round(sum(math.log(chance("allow", w)) - math.log(chance("block", w)) for w in p) / len(p), 9) for a, p in places.items()}
    bins = {a: math.floor(score[a] * grid) for a in label if held[a] and label[a][1]}
    good, bad = (sum(label[a][1] == k for a in bins) for k in ("allow", "block"))
    cut = 0.0
    if good and bad:
        gain = lambda b: sum(bins[a] >= b for a in bins if label[a][1] == "allow") * bad - sum(bins[a] >= b for a in bins if label[a][1] == "block") * good
        cut = min({*bins.values(), max(bins.values()) + 1}, key=lambda b: (-gain(b), b)) / grid
    return {u: (*a, label[a][0], label[a][1] or ("block" if score[a] < cut else "allow"), score[a]) for u, a in parts.items()}


ODD_URLS = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/1?x=/en/", "http://a.b.example.com", "http://example.com#f", "http://example.com/en",
            "http://xexample.com/en/1", "http://a.www.example.com/en/é", "x://y://z.net/es/1", "http://net/fr/", "http://h.net:80/es/", "ftp://ÄB.net/es/😀",
            "http://long.org/" + "ab/" * 20_000, "http://user@h.com/", "http://h.org/\u2028line"]


@pytest.mark.parametrize("options", [{}, {"hot": 50, "order": 2, "least": 1, "grid": 8}])
def test_op11_brute_force(spark, options):
    urls = [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()] + ODD_URLS
    rnd = random.Random(4)
    urls += [f"http://{rnd.choice('abc')}.example.{rnd.choice(['com', 'net', 'org'])}/{rnd.choice(['en', 'de', 'es', 'fr'])}/{rnd.randrange(999)}" for _ in range(400)]
    urls += urls[:20]
    pages = spark.createDataFrame([(k, u, "x", 1) for k, u in enumerate(urls)], "page_id long, url string, host string, score int")
    expected = slow_filter(urls, **{k: v for k, v in options.items() if k != "hot"})
    got = {r.rest.page_id: r for r in op11.judged(pages, **options).collect()}
    assert len(got) == len(urls)
    for k, u in enumerate(urls):
        r = got[k]
        assert (r.host, r.path, r.rule, r.verdict) == expected[u][:4] and abs(r.score - expected[u][4]) < 1e-8 and r.rest.host == "x"
    assert {r.verdict for r in got.values() if r.rule is None} == {"allow", "block"}


def test_op11_without_decided_addresses_and_empty(spark):
    pages = spark.createDataFrame([(None, "http://a.org/x"), (1, None), (1, None)], "page_id long, url string")
    got = op11.digest(op11.judged(pages)).collect()
    assert sorted((r.page_id is None, r.host, r.rule, r.verdict) for r in got) == [(False, "", None, "allow")] * 2 + [(True, "a.org", None, "allow")]
    assert op11.digest(op11.judged(pages.limit(0))).count() == 0
    plan = op11.judged(pages)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# 12 -----------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_op12_eigenvectors(n):
    rnd = np.random.default_rng(n)
    g = rnd.standard_normal((n, n))
    q = np.linalg.qr(g)[0]
    of = lambda values: q @ np.diag(values) @ q.T
    for a in (g @ g.T, np.eye(n) * 3, np.zeros((n, n)), np.outer(g[0], g[0]), of([1.0 + i // 3 for i in range(n)]), np.diag(rnd.random(n)),
              of([1 + 1e-9 * i for i in range(n)]), of([10.0 ** -i for i in range(n)])):
        a = (a + a.T) / 2
        values, vectors = op12.eigen(a)
        size = max(np.linalg.norm(a), 1e-300)
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-14 * size and np.linalg.norm(a @ vectors - vectors * values) <= 1e-13 * size
        assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13


def slow_whitening(rows, components=4):
    x = {i: [[math.floor(256 * c) for c in v] for v in vs] for i, vs in rows.items()}
    fit = np.array(sorted({tuple(v) for vs in x.values() for v in vs}), float)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    w = (fit - fit.mean(axis=0)) @ vectors[:, ::-1][:, :components] / np.sqrt(values[::-1][:components])
    return n, sums, values[::-1], vectors[:, ::-1], x, fit.mean(axis=0), w


def test_op12_against_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = defaultdict(list)
    for r in table.collect():
        rows[r.vec_id].append(r.embedding)
    n, sums, values, vectors, x, mean, _ = slow_whitening(rows)
    got = op12.whitened(table).collect()
    assert len(got) == 4 * sum(map(len, rows.values())) and {r.component for r in got} == {1, 2, 3, 4} and {r.n for r in got} == {n}
    sign = {}
    for r in got:
        own = x[r.vec_id][0]
        expected = float((np.array(own) - mean) @ vectors[:, r.component - 1] / values[r.component - 1] ** 0.5)
        s = sign.setdefault(r.component, 1 if abs(r.whitened - expected) < abs(r.whitened + expected) else -1)
        assert abs(r.whitened - s * expected) < 1e-9 and r.deviation == sum((n * a - b) ** 2 for a, b in zip(own, sums))
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-12 and r.identity_error < 1e-10


def test_op12_odd_rows(spark):
    rnd = np.random.default_rng(7)
    good = [(k, [float(c) for c in rnd.standard_normal(3)]) for k in range(30)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 0.0, 0.0]), (103, [float("inf"), 0.0, 0.0]), (104, []), (105, [1.0, 2.0]), (None, good[0][1]), (0, good[0][1])]
    data = spark.createDataFrame([(k, v, 1, "n") for k, v in good + odd], "vec_id long, embedding array<double>, n int, whitened string")
    got = op12.whitened(data).collect()
    assert Counter(r.vec_id for r in got) == {**{k: 3 for k in range(1, 30)}, 0: 6, None: 3, 104: 3, 105: 3}
    assert all(r.whitened is None and r.deviation is None for r in got if r.vec_id in (104, 105)) and {r.n for r in got} == {30}
    assert {round(r.whitened, 9) for r in got if r.vec_id is None} == {round(r.whitened, 9) for r in got if r.vec_id == 0}
    assert max(r.identity_error for r in got) < 1e-10 and abs(sum(r.explained for r in got if r.vec_id == 1) - 1) < 1e-12
    assert op12.whitened(data.limit(0)).count() == 0
    assert op12.whitened(data.where("vec_id = 0 OR vec_id IS NULL")).count() == 0                      # one vector: no variance
    large = spark.createDataFrame([(1, [3e9, 1.0]), (2, [-3e9, 5.0]), (3, [1e38, 2.0]), (4, [0.5, 9.0])], "vec_id long, embedding array<double>")
    out = {(r.vec_id, r.component): r for r in op12.whitened(large).collect()}
    x = {1: [768_000_000_000, 256], 2: [-768_000_000_000, 1280], 3: [2 ** 40, 512], 4: [128, 2304]}
    sums = [sum(c) for c in zip(*x.values())]
    for k, v in x.items():
        exact = sum((4 * a - b) ** 2 for a, b in zip(v, sums))
        assert out[k, 1].deviation == (exact if exact < 2 ** 63 else None) and out[k, 1].identity_error < 1e-8


# 13 -----------------------------------------------------------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def slow_tree(digests, fanout):
    """The top, and for each leaf its path of (left, right)."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i in range(len(paths)):
            first = at[i] // fanout * fanout
            paths[i].append(("".join(level[first:at[i]]), "".join(level[at[i] + 1:first + fanout])))
            at[i] //= fanout
        level = [sha("".join(level[k:k + fanout])) for k in range(0, len(level), fanout)]
    return level[0], paths


def slow_manifest(rows, fanout=16):
    """rows of (doc_id, source, lang, n_chars, text) -> sorted results."""
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[1]].append((r[0] is not None, r[0] or 0, slow_leaf(r), r))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: slow_tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])], fanout) for s in sources}
    root, over = slow_tree([trees[s][0] for s in sources], fanout)
    out = []
    for s, upper in zip(sources, over):
        for (_, _, leaf, r), path in zip(sorted(by_source[s], key=lambda x: x[:3]), trees[s][1]):
            node = leaf
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                node = slow_leaf([*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])])
            for left, right in path + upper:
                node = sha(left + node + right)
            out.append((r[0], leaf, trees[s][0], root, sha("".join(a + b for a, b in path + upper)), node, node == root))
    return sorted(out, key=repr)


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("fanout", [16, 3])
def test_op13_brute_force(spark, fanout):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    rows = [tuple(r) for r in docs.collect()]
    extra = spark.createDataFrame([(900, "lone", None, None, "ABC"), (901, None, "en", 3, None), (5, None, "en", 3, "Q"), (5, None, "en", 3, "Q"), (5, None, "en", 4, "Q"),
                                   (None, None, "en", 3, "Ä😀Z"), (None, "", "", 0, ""), (-7, "", "de", 1, "X" * 300_000), (15, "\U0001F600", "en", 1, "ABC"), (20, "\uffff", "en", 1, "ABC")], FIELDS)
    every = docs.unionByName(extra).withColumn("tree", docs["doc_id"] * 0).withColumn("leaf", docs["text"]).withColumn("hi", docs["lang"])
    got = op13.digest(op13.manifest(every, fanout=fanout)).collect()
    expected = slow_manifest(rows + [tuple(r) for r in extra.collect()], fanout)
    assert sorted((tuple(r) for r in got), key=repr) == expected
    assert 0 < sum(not r.verified for r in got) < 0.3 * len(got)


def test_op13_small_tables(spark):
    one = spark.createDataFrame([(15, "s", "en", 1, "ABC")], FIELDS)
    assert [tuple(r) for r in op13.digest(op13.manifest(one)).collect()] == slow_manifest([(15, "s", "en", 1, "ABC")])
    assert op13.digest(op13.manifest(one.limit(0))).count() == 0
    many = spark.range(17 * 17).selectExpr("id doc_id", "'hot' source", "'en' lang", "1L n_chars", "concat('Text ', id) text")
    assert sorted((tuple(r) for r in op13.digest(op13.manifest(many)).collect()), key=repr) == slow_manifest([tuple(r) for r in many.collect()])
