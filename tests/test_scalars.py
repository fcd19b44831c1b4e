import os
import random
import re
from urllib.parse import parse_qs, urlencode, urljoin, urlparse, urlunparse

from pyspark.sql import functions as F

from harvest.functions import text as T
from harvest.functions.sizes import human_size
from harvest.functions.urls import page_url, replace_url_params, resolve_link


# ---- specifications written from the documented behaviour (brute force) ----
def spec_clean(title):
    s = title.replace(T.SITE_SUFFIX, "").replace(T.MAP_PHRASE, "")
    s = re.sub(r"[^\w]", "", s)
    if len(s) > 21:
        s = s[:21]
        while len(s.encode()) > 63:
            s = s[:-1]
    return s


def spec_file(path):
    base = os.path.basename(path)
    stem, ext = os.path.splitext(base)
    if len(stem) > 21:
        stem = stem[:21]
        while len(stem.encode()) > 63 - len(ext.encode()):
            stem = stem[:-1]
        return stem + ext
    return base


def spec_size(n):
    if n == 0:
        return "0 B"
    if n < 100:
        return f"{n} B"
    units, i, size = ["B", "KB", "MB", "GB", "TB"], 1, n / 1024
    while size >= 1000 and i < 4:
        size /= 1024
        i += 1
    if size < 10:
        return f"{size:.2f} {units[i]}"
    if size < 100:
        return f"{size:.1f} {units[i]}"
    return f"{int(size)} {units[i]}"


def spec_url(url, params):
    u = urlparse(url)
    q = parse_qs(u.query)
    for k, v in params.items():
        q[k] = [str(v)]
    return urlunparse(u._replace(query=urlencode(q, doseq=True)))


def _one(spark, values, fn, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col(df.columns[0]))).collect()]


def test_clean_table_name(spark):
    random.seed(3)
    alphabet = list("abcXYZ 09_-#.,") + ["農", "圖", "𠀀", "½", "é", " - 農業資料開放平臺", "農地空間圖"]
    titles = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(400)]
    titles += ["農" * 30, "𠀀" * 30, "a" * 30, "抽樣 - 農業資料開放平臺"]
    assert _one(spark, titles, T.clean_table_name) == [spec_clean(t) for t in titles]


def test_truncate_file_name(spark):
    names = ["/a/b/" + "農" * 25 + ".pdf", "/x/" + "a" * 30 + ".tar.gz", "/x/.bashrc", "/x/short.pdf",
             "/x/" + "𠀀" * 22 + ".pdf", "/x/a.", "/x/..a.b", "/x/" + "b" * 25]
    assert _one(spark, names, T.truncate_file_name) == [spec_file(n) for n in names]


def test_clean_keyword_and_ellipsis(spark):
    assert _one(spark, ["  Hello, World! ", None, "農業-資料"], T.clean_keyword) == ["hello world", "", "農業資料"]
    assert _one(spark, ["a" * 16, "b" * 15, None], T.ellipsis) == ["a" * 15 + "...", "b" * 15, None]


def test_human_size_matches_spec(spark):
    random.seed(7)
    vals = [0, 1, 99, 100, 1023, 1024, 10 * 1024, 100 * 1024, 1000 * 1024 - 1, 1000 * 1024, 1024 ** 4, 2000 * 1024 ** 4]
    vals += [random.randint(0, 10 ** 15) for _ in range(500)] + [512 * k for k in range(1, 300)]
    assert _one(spark, vals, human_size, "b long") == [spec_size(v) for v in vals]


def test_replace_url_params_matches_spec(spark):
    urls = ["http://h/p", "http://h/p?a=1&b=2&a=3", "http://h/p?a=&b=2#frag", "https://h/p?x=a+b&page=9",
            "http://h/p?q=%E8%BE%B2&y", "http://h/p#f", "http://h/p?tilde=~x&star=*"]
    params = {"page": "1", "lang": "zh tw"}
    got = _one(spark, urls, lambda c: replace_url_params(c, params))
    assert got == [spec_url(u, params) for u in urls]


def test_page_url_and_resolve(spark):
    df = spark.createDataFrame([("http://h/a?x=1",), ("http://h/a",)], "u string")
    assert [r[0] for r in df.select(page_url(F.col("u"), 1000)).collect()] == [
        "http://h/a?x=1&$skip=1000", "http://h/a?$skip=1000"]
    pairs = [("http://h/d/p.html?q=1", "/x"), ("http://h/d/p.html", "y.pdf"), ("https://h/d/", "//o/z"),
             ("http://h/d/p", "https://e/f"), ("http://h/d/p?q", "?r=1"), ("http://h/d/p?q", "#t"), ("http://h", "a")]
    df = spark.createDataFrame(pairs, "b string, l string")
    got = [r[0] for r in df.select(resolve_link("b", "l")).collect()]
    assert got == [urljoin(b, l) for b, l in pairs]


def test_small_helpers(spark):
    assert _one(spark, ["上", "後", "二", "x", None], T.rank_word) == [1, 3, 2, None, None]
    assert _one(spark, ["1.5", "x", None], T.safe_float) == [1.5, None, None]
    assert _one(spark, ["1010001", "12"], T.right_chars) == ["1010001", "12"]
    assert _one(spark, ["interruption_record_20250102_030405.json", "x.json"], T.snapshot_time)[1] is None


def test_links_fold_dot_segments(spark):
    from urllib.parse import urljoin

    from harvest.functions.urls import resolve_link
    bases = ["http://h/p/q/r.html", "https://h.tw/p/?a=../b", "http://h", "http://h/"]
    links = ["../api/x.json", "./x", "x/../y?z=../w#../v", "../../../up", "/a/./b/../c", "/..", ".", "..", "a/b/..", "x...y", "..x/y", "q?p=/../"]
    got = spark.createDataFrame([(b, li) for b in bases for li in links], "b string, l string").select(
        "b", "l", resolve_link("b", "l").alias("u")).collect()
    for r in got:
        assert r.u == urljoin(r.b, r.l), r
