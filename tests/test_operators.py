import json
import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from harvest.operators import catalog, dedup, ids, incremental, ordering, quality, upsert
from harvest.operators.numbering import consecutive_index


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _skewed(spark, n=3000):
    random.seed(11)
    rows = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else f"k{random.randint(0, 40)}"   # one key holds a third of the rows
        rows.append((i, k, random.choice([None, 1, 2]), random.random()))
    return spark.createDataFrame(rows, "rid long, k string, g int, v double")


def test_keep_first_last_match_brute_force(spark):
    df = _skewed(spark)
    data = df.collect()
    first, last = {}, {}
    for r in data:
        key = (r.k, r.g)
        if key not in first or r.rid < first[key].rid:
            first[key] = r
        if key not in last or r.rid > last[key].rid:
            last[key] = r
    assert _rows(dedup.keep_first(df, ["k", "g"], "rid"), "rid") == sorted((r.rid,) for r in first.values())
    assert _rows(dedup.keep_last(df, ["k", "g"], "rid"), "rid") == sorted((r.rid,) for r in last.values())
    # idempotent
    once = dedup.keep_first(df, ["k", "g"], "rid")
    assert _rows(dedup.keep_first(once, ["k", "g"], "rid"), "rid") == _rows(once, "rid")


def test_duplicate_stats_and_surplus(spark):
    df = _skewed(spark)
    c = Counter((r.k, r.g) for r in df.collect())
    st = dedup.duplicate_stats(df, ["k", "g"]).collect()[0]
    assert st.total_rows == sum(c.values()) and st.duplicate_rows == sum(v - 1 for v in c.values())
    assert dedup.surplus_rows(df, ["k", "g"], "rid").count() == st.duplicate_rows
    prev = dedup.duplicate_preview(df, ["k", "g"], "rid", n=10).collect()
    assert len(prev) == 10


def test_distinct_rows_with_ordinal(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "a", 5), (2, None, 1), (2, None, 2)], "x int, y string, o int")
    assert _rows(dedup.distinct_rows(df, "o"), "x", "o") == [(1, 0), (2, 1)]


def test_anti_join_and_matches_cover_input(spark):
    inc = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, None, None), (4, "d", 4), (5, "d", 4)],
                                "id long, k1 string, k2 int")
    store = spark.createDataFrame([("a", None, "s1", 1), ("a", None, "s2", 2), (None, None, "s3", 3), ("x", 9, "s4", 4)],
                                  "k1 string, k2 int, sid string, o int")
    new = incremental.new_rows(inc, store, ["k1", "k2"])
    hit = incremental.matched_ids(inc, store, ["k1", "k2"], "sid", "o", "id")
    assert _rows(new, "id") == [(2,), (4,), (5,)]            # batch duplicates kept
    assert _rows(hit, "id", "sid") == [(1, "s2"), (3, "s3")]  # NULL == NULL; last stored duplicate wins
    assert len(_rows(new, "id")) + len(_rows(hit, "id")) == inc.count()


def test_rows_not_in_and_combine(spark):
    ex = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    new = spark.createDataFrame([(1, "a", "n"), (2, None, "n"), (3, "c", "n")], "x int, y string, z string")
    assert _rows(incremental.rows_not_in(new, ex), "x") == [(3,)]
    assert _rows(incremental.combine_batches(ex, new), "x") == [(3,)]            # different column sets
    same = new.drop("z")
    assert _rows(incremental.combine_batches(ex, same), "x") == [(1,), (2,), (3,)]


def test_first_free_sequence_edge_cases(spark):
    rows = [("empty", None), ("contig", 1), ("contig", 2), ("contig", 3), ("gap1", 2), ("gap1", 3),
            ("mid", 1), ("mid", 2), ("mid", 4), ("zero", 0), ("zero", 1)]
    df = spark.createDataFrame(rows, "p string, s long")
    groups = spark.createDataFrame([("empty",)], "p string")
    got = dict(ids.first_free_sequence(df, "s", ["p"], groups=groups).collect())
    assert got == {"empty": 1, "contig": 4, "gap1": 1, "mid": 3, "zero": 2}
    cat = spark.createDataFrame([("101", "1010001"), ("101", "1010002"), ("101", "1020003"), ("101", "10100x1"),
                                 ("102", "1020002")], "prefix string, dataset_id string")
    got = dict(ids.next_dataset_ids(cat).collect())
    assert got == {"101": "1010003", "102": "1020001"}
    assert ids.max_sequence(spark.createDataFrame([("12",), ("x",)], "i string"), "i").collect()[0][0] == 12


def _allocated(spark, used, reqs):
    free = ids.free_intervals(spark.createDataFrame(used, "g string, s long"), "s", "g")
    return ids.allocate(free, spark.createDataFrame(reqs, "g string, r long"), "g", "r", "n")[0].collect()


def test_allocate_free_is_sequential_first_gap(spark):
    random.seed(5)
    used = [("a", s) for s in random.sample(range(1, 60), 30)] + [("b", 1), ("b", 2)]
    reqs = [("a", r) for r in range(1, 41)] + [("b", 1), ("c", 1), ("c", 2)]
    got = _allocated(spark, used, reqs)
    got = {(x.g, x.r): x.n for x in got}
    for g in ("a", "b", "c"):
        taken = {s for gg, s in used if gg == g}
        for r in range(1, 1 + sum(1 for gg, _ in reqs if gg == g)):
            n = 1
            while n in taken:
                n += 1
            taken.add(n)
            assert got[(g, r)] == n


def test_consecutive_index_skewed_groups(spark):
    df = _skewed(spark).repartition(7)
    out = consecutive_index(df, ["rid"], ["k"], name="pos").collect()
    by = {}
    for r in out:
        by.setdefault(r.k, []).append((r.rid, r.pos))
    for k, lst in by.items():
        lst.sort()
        assert [p for _, p in lst] == list(range(1, len(lst) + 1)), k
    glob = consecutive_index(df, [F.col("v").desc(), "rid"], name="pos").collect()
    assert sorted(r.pos for r in glob) == list(range(1, len(glob) + 1))


def test_typed_sort_total_order(spark):
    rows = [(1, "下", "3", "2025/1/2"), (2, "上", "x", "111"), (3, "b", None, None), (4, "中", "10", "2024"),
            (5, None, "2.5", "bad"), (6, "a", "-1", "99/1/1")]
    df = spark.createDataFrame(rows, "o int, t string, n string, d string")
    got = [r.o for r in ordering.typed_sort(df, [["t", "text_asc"]], "o").collect()]
    assert got == [2, 4, 1, 5, 6, 3]   # rank words first, then NULL as '', then text
    got = [r.o for r in ordering.typed_sort(df, [["n", "number_asc"]], "o").collect()]
    assert got == [6, 5, 1, 4, 2, 3]   # numbers, then text, then NULL
    got = [r.o for r in ordering.typed_sort(df, [["d", "date_asc"]], "o").collect()]
    assert got == [3, 5, 6, 2, 4, 1]   # unparseable first; 99/1/1=2010, 111=2022


def test_upsert_semantics_and_idempotence(spark):
    t0, now = dt.datetime(2025, 1, 1), dt.datetime(2025, 6, 1)
    store = spark.createDataFrame([("1", "a", "x", t0, t0), ("2", "b", "y", t0, t0)],
                                  "dataset_id string, title string, category string, created_at timestamp_ntz, last_updated_at timestamp_ntz")
    batch = spark.createDataFrame([("2", "B", None, 1), ("2", "B2", None, 2), ("3", "c", "p", 1)],
                                  "dataset_id string, title string, provider string, o int")
    out = upsert.upsert(store, batch, "dataset_id", now=now, ord_col="o")
    got = {r.dataset_id: r for r in out.collect()}
    assert got["1"].title == "a" and got["1"].last_updated_at == t0
    assert got["2"].title == "B2" and got["2"].category == "y" and got["2"].created_at == t0
    assert got["2"].last_updated_at == now and got["2"].provider is None
    assert got["3"].created_at == now and got["3"].category is None
    again = upsert.upsert(out, batch, "dataset_id", now=now, ord_col="o")
    assert _rows(again, *out.columns) == _rows(out, *out.columns)


def test_replace_insert_delete(spark):
    store = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert _rows(upsert.replace_by_key(store, batch, "k"), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]
    assert _rows(upsert.insert_if_absent(store, batch, "k"), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]
    assert _rows(upsert.delete_by_key(store, batch, "k"), "k") == [(1,)]


def test_reconcile_all_seven_combinations(spark):
    # A: catalog only, B: raw only, C: processed only, AB, AC, BC, ABC
    cat = spark.createDataFrame([(i, f"t{i}") for i in ("A", "AB", "AC", "ABC")], "dataset_id string, title string")
    names = spark.createDataFrame([(n,) for n in ("B", "AB", "BC", "ABC", "C_processed", "AC_processed",
                                                  "BC_processed", "ABC_processed")], "table_name string")
    got = {r.dataset_id: (r.in_catalog, r.in_raw, r.in_processed)
           for r in catalog.reconcile(cat, names, id_pattern=".*").collect()}
    assert got == {"A": (True, False, False), "B": (False, True, False), "C": (False, False, True),
                   "AB": (True, True, False), "AC": (True, False, True), "BC": (False, True, True),
                   "ABC": (True, True, True)}
    assert [r.dataset_id for r in catalog.orphan_entries(catalog.reconcile(cat, names, id_pattern=".*")).collect()] == ["A"]
    svc = spark.createDataFrame([("files",), ("1010001",), ("1010001_processed",), ("all_sort_configs",)], "table_name string")
    cat7 = spark.createDataFrame([("1010001", "t")], "dataset_id string, title string")
    assert [(r.dataset_id, r.in_raw, r.in_processed) for r in catalog.reconcile(cat7, svc).collect()] == [
        ("1010001", True, True)]


def test_rekey_refuses_existing(spark):
    cat = spark.createDataFrame([("1",), ("2",)], "dataset_id string")
    out = catalog.rekey({"c": (cat, "dataset_id")}, "1", "2", cat)
    assert _rows(out["c"], "dataset_id") == [("1",), ("2",)]
    out = catalog.rekey({"c": (cat, "dataset_id")}, "1", "9", cat)
    assert _rows(out["c"], "dataset_id") == [("2",), ("9",)]


def test_date_rules(spark):
    assert quality.pick_date_column(["a", "update_time", "Date_x"]) == "update_time"   # substring rule (Q5)
    assert quality.pick_date_column(["分布圖Url", "date"]) is None
    assert quality.pick_date_column(["年度", "crop_uid"]) == "年度"
    df = spark.createDataFrame([("2024/12/31",), ("2025/1/1",), ("x",)], "date string")
    assert quality.date_cutoff(df).count() == 1
    assert quality.date_cutoff(df, 1900, 1, 1).count() == 3        # invalid cutoff -> unchanged
    assert quality.date_cutoff(df.withColumnRenamed("date", "v")).count() == 3   # no date column


def test_metadata_integrity_and_routing(spark):
    meta = spark.createDataFrame([("t", "農糧", "u", "2025/01/01 00:00:00"), ("t", "x", "u", "d"), ("t", "農糧", " ", "d")],
                                 "title string, category string, api_url string, updated_at_src string")
    st = [r.status for r in quality.metadata_integrity(meta, quality.category_table(spark)).collect()]
    assert st == ["ok", "unknown_category", "missing"]
    df = spark.createDataFrame([("a 代碼", None), ("b", "http://m"), ("c", ""), ("d 空間", None)], "t string, m string")
    assert [r[0] for r in df.select(quality.load_mode(F.col("t"), F.col("m"))).collect()] == [
        "full", "full", "incremental", "full"]


def test_incremental_load_cuts_store_only_for_date_keys(spark):
    inc = spark.createDataFrame([(1, "2025/02/01"), (2, "2024/12/01"), (3, "2025/03/01")], "id int, date string")
    store = spark.createDataFrame([(1, "2024/01/01"), (3, "2025/03/01")], "id int, date string")
    out = incremental.incremental_load(inc, store, ["id"], cutoff=dt.date(2025, 1, 1))
    assert _rows(out, "id") == []          # id 1 matches its stored copy even though that copy is old
    out = incremental.incremental_load(inc, store, ["id", "date"], cutoff=dt.date(2025, 1, 1))
    assert _rows(out, "id") == [(1,)]      # date is a key: different date -> new


def test_distinct_records_key_order_and_missing_vs_null(spark):
    texts = ['{"a":1,"b":2}', '{"b":2,"a":1}', '{"a":1}', '{"a":1,"b":null}', '{"a":1.0}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "_ord int, t string") \
        .select("_ord", F.parse_json("t").alias("v"))
    kept = sorted(r._ord for r in dedup.distinct_records(df).collect())
    assert kept == [0, 2, 3]   # 1.0 folds into 1 in VARIANT (documented)


def test_contains_join_expansion_matches_broadcast(spark):
    from harvest.operators.joins import contains_join
    hay = spark.createDataFrame([(i, t) for i, t in enumerate(["abcabc", "農業資料", "xyz", "", None, "aa"])],
                                "hid int, h string")
    needles = spark.createDataFrame([("a",), ("bc",), ("業資",), ("zz",), ("",), ("aa",)], "n string")
    small = _rows(contains_join(hay, "h", needles, "n"), "hid", "n")
    big = _rows(contains_join(hay, "h", needles, "n", literal_needles=0), "hid", "n")
    assert small == big == [(0, "a"), (0, "bc"), (1, "業資"), (5, "a"), (5, "aa")]


def test_spec_sort_key_matches_typed_sort(spark):
    rows = [(1, "下", "3", "2025/1/2"), (2, "上", "x", "111"), (3, "b", None, None), (4, "中", "10", "2024"),
            (5, None, "2.5", "bad"), (6, "a", "-1", "99/1/1"), (7, "a", "-1", "2024"),
            (8, "中文", "7", "2025"), (9, "一月", "七", "2025"), (10, "丁", "一", "2025"), (11, "B", "y", None), (12, "業", "Y", "2023")]
    df = spark.createDataFrame(rows, "o int, t string, n string, d string")
    for spec in ([["t", "text_asc"], ["n", "number_asc"]], [["d", "date_asc"], ["t", "text_asc"]],
                 [["n", "number_asc"], ["d", "date_asc"]]):
        want = [r.o for r in ordering.typed_sort(df, spec, "o").collect()]
        fields = F.create_map(*[x for c in ("t", "n", "d") for x in (F.lit(c), F.col(c))])
        spec_col = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in spec])
        got = [r.o for r in df.orderBy(ordering.spec_sort_key(fields, spec_col), "o").collect()]
        assert got == want, (spec, got, want)


def test_datasets_matching_for_deletes(spark):
    cat = spark.createDataFrame([("1010001", "rice prices", "crops", 1), ("1010002", "fish catch", "fishery", 2),
                                 ("1010003", "rice area", "crops", 3)], "dataset_id string, title string, category string, ord int")
    pick = lambda **kw: sorted(r[0] for r in catalog.datasets_matching(cat, **kw).collect())
    assert pick(category="crops") == ["1010001", "1010003"]
    assert pick(keyword="Rice!") == ["1010001", "1010003"]          # fuzzy: every hit
    assert pick(keyword="fish catch") == ["1010002"]                # exact title wins alone
    ids = spark.createDataFrame([("1010002",)], "x string")
    assert pick(ids=ids, category="crops") == ["1010001", "1010002", "1010003"]
    doomed = catalog.datasets_matching(cat, keyword="rice")
    rows = spark.createDataFrame([("1010001", 1), ("1010002", 2)], "dataset_id string, v int")
    out = catalog.cascade_delete(cat, {"rows": (rows, "dataset_id")}, doomed)
    assert _rows(out["parent"], "dataset_id") == [("1010002",)] and _rows(out["rows"], "v") == [(2,)]


def test_keep_first_last_with_null_ordinals(spark):
    df = spark.createDataFrame([("a", None, "n"), ("a", 2, "two"), ("a", 5, "five"), ("b", None, "only")],
                               "k string, o int, v string")
    assert _rows(dedup.keep_first(df, ["k"], "o"), "k", "v") == [("a", "two"), ("b", "only")]
    assert _rows(dedup.keep_last(df, ["k"], "o"), "k", "v") == [("a", "n"), ("b", "only")]


def test_upsert_keeps_a_null_created_at(spark):
    t0, now = dt.datetime(2025, 1, 1), dt.datetime(2025, 6, 1)
    store = spark.createDataFrame([("1", "a", None, t0)],
                                  "dataset_id string, title string, created_at timestamp_ntz, last_updated_at timestamp_ntz")
    batch = spark.createDataFrame([("1", "A")], "dataset_id string, title string")
    r = upsert.upsert(store, batch, "dataset_id", now=now).collect()[0]
    assert r.title == "A" and r.created_at is None and r.last_updated_at == now


def test_anti_join_text_compare_across_types(spark):
    inc = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, k bigint")
    store = spark.createDataFrame([("5",), ("06",), (None,)], "k string")   # text keys: '5' matches, '06' does not
    assert _rows(incremental.new_rows(inc, store, ["k"]), "id") == [(2,)]
    dbl = spark.createDataFrame([(1, 0.0), (2, 1.5)], "id int, k double")
    st2 = spark.createDataFrame([(-0.0,), (1.5,)], "k double")           # doubles compare as text: '-0.0' != '0.0'
    assert _rows(incremental.new_rows(dbl, st2, ["k"]), "id") == [(1,)]


def test_anti_join_nested_key_values(spark):
    inc = spark.createDataFrame([(1, (1, "x")), (2, (2, "y"))], "id int, k struct<a:int,b:string>")
    store = spark.createDataFrame([((1, "x"),)], "k struct<a:int,b:string>")
    assert _rows(incremental.new_rows(inc, store, ["k"]), "id") == [(2,)]


def test_allocate_free_random_densities(spark):
    for seed, top, n_used, n_req in ((1, 20, 19, 5), (2, 200, 50, 120), (3, 30, 0, 3), (4, 10, 10, 1)):
        random.seed(seed)
        used = [("g", s) for s in random.sample(range(1, top + 1), n_used)] + [("g", 0), ("h", 7)]
        reqs = [("g", r) for r in range(1, n_req + 1)] + [("h", 1), ("h", 2)]
        got = _allocated(spark, used, reqs)
        got = {(x.g, x.r): x.n for x in got}
        for g in ("g", "h"):
            taken = {s for gg, s in used if gg == g and s >= 1}
            for r in range(1, 1 + sum(1 for gg, _ in reqs if gg == g)):
                n = 1
                while n in taken:
                    n += 1
                taken.add(n)
                assert got[(g, r)] == n, (seed, g, r)


def test_ids_widen_instead_of_being_cut(spark):
    from harvest.functions.text import compose_id
    df = spark.createDataFrame([(n,) for n in (7, 9_999_999, 10_000_000, 10_000_001, 10_000_009)], "n long")
    got = [r[0] for r in df.select(compose_id(F.lit("1010003"), F.col("n"))).collect()]
    assert got == ["10100030000007", "10100039999999", "101000310000000", "101000310000001", "101000310000009"]


def test_freshness_with_repeated_titles(spark):
    from harvest.operators.quality import freshness_status, category_table
    cats = category_table(spark)
    c = cats.first()
    batch = spark.createDataFrame([("a", c.category, "1"), ("a", c.category, "2"), ("b", c.category, "1"), ("b", c.category, "1")],
                                  "title string, category string, updated_at_src string")
    catalog = spark.createDataFrame([("b", c.prefix + "0001", "1"), ("b", c.prefix + "0002", "0")], "title string, dataset_id string, updated_at_src string")
    got = sorted(tuple(r) for r in freshness_status(batch, catalog, cats).select("title", "status", "dataset_id").collect())
    assert got == [("a", "new", c.prefix + "0003"), ("b", "unchanged", c.prefix + "0001")]


def test_free_intervals_are_kept_between_allocations(spark):
    random.seed(8)
    used = {g: set(random.sample(range(1, 50), k)) for g, k in (("a", 25), ("b", 1), (None, 10))}
    free = ids.free_intervals(spark.createDataFrame([(g, s) for g, ss in used.items() for s in ss], "g string, s long"), "s", "g")
    got = {(r.g, r.lo, r.hi) for r in free.collect()}
    for g, ss in used.items():
        numbers = {n for gg, lo, hi in got if gg == g for n in range(lo, (hi or 60) + 1)}
        assert numbers == set(range(1, 61)) - ss and sum(hi is None for gg, _, hi in got if gg == g) == 1
    used["c"] = set()
    for wants in ({"a": 3, "c": 2}, {"a": 1, "b": 5}, {"a": 30, None: 4, "c": 1}):
        reqs = spark.createDataFrame([(g, r, "x") for g, k in wants.items() for r in range(1, k + 1)], "g string, r long, lo string")
        out, free = ids.allocate(free, reqs, "g", "r", "n")
        given = {(x.g, x.r): x.n for x in out.collect()}
        free = free.checkpoint()
        for g, k in wants.items():
            for r in range(1, k + 1):
                n = next(i for i in range(1, 999) if i not in used[g])
                used[g].add(n)
                assert given[g, r] == n
        assert len(given) == sum(wants.values())


def test_null_keys_are_keys(spark):
    store = spark.createDataFrame([("a", None, 1), (None, "x", 2), ("b", "y", 3)], "k string, l string, v int")
    batch = spark.createDataFrame([("a", None, 9), (None, "x", 8), (None, None, 7)], "k string, l string, v int")
    assert _rows(upsert.replace_by_key(store, batch, ["k", "l"]), "v") == [(3,), (7,), (8,), (9,)]
    assert _rows(upsert.delete_by_key(store, batch, ["k", "l"]), "v") == [(3,)]
    assert _rows(upsert.upsert(store, batch, ["k", "l"], audit=False), "v") == [(3,), (7,), (8,), (9,)]
    once = upsert.insert_if_absent(store, store.limit(0).unionByName(store).unionByName(batch))
    assert once.count() == 6 and upsert.insert_if_absent(once, batch).count() == 6


def test_kept_and_surplus_rows_are_the_input(spark):
    """Ties, NULL ordinals, NULL keys, rows equal in everything, variants: what is kept and what is deleted add up."""
    random.seed(3)
    rows = [(random.choice(["a", "b", None, "hot", "hot", "hot"]), random.choice([None, 1, 2, 3]), random.choice("xy"), '{"n": %d}' % random.randrange(2)) for _ in range(300)] + [("one", 1, "z", "1")]
    df = spark.createDataFrame(rows, "k string, o int, t string, j string").select("k", "o", "t", F.try_parse_json("j").alias("v"))
    flat = lambda d: sorted(map(repr, d.select("k", "o", "t", F.to_json("v").alias("v")).collect()))
    for keep, first in ((dedup.keep_first, True), (dedup.keep_last, False)):
        kept = flat(keep(df, ["k"], "o"))
        assert sorted(kept + flat(dedup.surplus_rows(df, ["k"], "o", keep="first" if first else "last"))) == flat(df) and len(kept) == 5
        assert kept == flat(keep(df.orderBy(F.rand()).repartition(5), ["k"], "o"))     # the same rows however they lie
    stats = dedup.duplicate_stats(df, ["k"]).first()
    assert stats.duplicate_rows == 296 and dedup.duplicate_preview(df.drop("v"), ["k"], "o", n=1000).count() == 296


def test_located_dedup_moves_places_only(spark, tmp_path):
    random.seed(4)
    path = str(tmp_path / "rows")
    rows = [(random.choice(["a", None, "hot", "hot", *map(str, range(k))]), random.choice([None, 1, 2]), "p" * 50 + str(i)) for i, k in zip(range(400), [3, 300] * 200)]
    spark.createDataFrame(rows, "k string, o int, payload string").repartition(7).write.parquet(path)
    df = spark.read.parquet(path)
    for keep, name in ((dedup.keep_first_located, "first"), (dedup.keep_last_located, "last")):
        kept, gone = _rows(keep(df, ["k"], "o"), "payload"), _rows(dedup.surplus_located(df, ["k"], "o", keep=name), "payload")
        assert sorted(kept + gone) == _rows(df, "payload") and len(kept) == len({r[0] for r in rows})
        best = {r[0]: r for r in keep(df, ["k"], "o").collect()}
        for k in best:
            orders = [r[1] for r in rows if r[0] == k]
            rank = lambda o: (o is None, o or 0)
            assert best[k].o == (min if name == "first" else max)(orders, key=rank)
    plan = dedup.keep_first_located(df, ["k"], "o")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[k" in plan and not any("payload" in line for line in plan.splitlines() if "Aggregate" in line or "Exchange" in line)


@pytest.mark.parametrize("literal", [64, 0])
def test_contains_join_brute_force(spark, literal):
    from harvest.operators.joins import contains_join
    random.seed(6)
    text = lambda n: "".join(random.choice("ab農業😀 ") for _ in range(n))
    hay = [(i, text(random.randrange(14))) for i in range(80)] + [(80, None), (81, "abcabc"), (82, "abcabc")]
    needles = [(text(random.randrange(7)), i) for i in range(40)] + [(None, 98), ("", 99), ("bca", 100), ("bca", 101)]
    out = contains_join(spark.createDataFrame(hay, "hid int, h string"), "h", spark.createDataFrame(needles, "n string, nid int"), "n", literal_needles=literal)
    got = sorted((r.hid, r.nid) for r in out.collect())
    assert got == sorted((i, k) for i, h in hay for n, k in needles if h is not None and n and n in h) and len(got) > 50


def test_running_maximum_and_sum(spark):
    from harvest.operators.numbering import running
    random.seed(9)
    rows = [(random.choice(["hot"] * 5 + ["a", None]), i, random.choice([None, random.randrange(100)])) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int, v int").repartition(6)
    for how in ("max", "sum"):
        got = {r.i: r for r in running(df, F.col("v").cast("long"), ["i"], ["g"], "upto", how=how, before="ahead", following={"nxt": "i"}).collect()}
        for g in ("hot", "a", None):
            own = [r for r in rows if r[0] == g]
            for k, (_, i, _) in enumerate(own):
                seen = [v for _, _, v in own[:k + 1] if v is not None]
                ahead = [v for _, _, v in own[:k] if v is not None]
                f = max if how == "max" else sum
                assert got[i].upto == (f(seen) if seen else None) and got[i].ahead == (f(ahead) if ahead else None)
                assert got[i].nxt == (own[k + 1][1] if k + 1 < len(own) else None)


def test_page_gaps_after_a_long_page(spark):
    from harvest.sources.landing import page_coverage, page_gaps
    m = spark.createDataFrame([("d", 0, 10_999), ("d", 1_000, 1_000), ("d", 12_000, 5), ("e", 0, 0)], "dataset_id string, skip long, n_rows long")
    assert _rows(page_gaps(m), "dataset_id", "skip", "covered_to", "gap") == [("d", 0, 10_999, -9_999), ("d", 1_000, 10_999, 1_001), ("d", 12_000, 12_005, None), ("e", 0, 0, None)]
    assert _rows(page_coverage(m), "dataset_id", "pages", "rows_returned", "covered", "covered_again", "missing") == [("d", 3, 12_004, 11_004, 1_000, 1_001), ("e", 1, 0, 0, 0, 0)]


def test_size_check_reads_no_more_rows_than_the_bound(spark):
    from harvest.operators.joins import is_small
    assert is_small(spark.range(10), 10) and not is_small(spark.range(11), 10) and is_small(spark.range(0), 0)
    assert not is_small(spark.range(1 << 40), 10)          # the whole range would take hours
