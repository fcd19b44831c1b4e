"""URL filter: allow and block rules first, then a character language-model ratio. DataFrame functions only.

The addresses (host and path) that a rule decides are the training material: variable-order Markov models of the accepted and of
the rejected ones. A character's probability after a context of up to ``order`` characters is the context's own estimate mixed
with that of the context one character shorter (Witten-Bell: by how many different characters followed the context), down to a
uniform one; contexts seen fewer than ``least`` times in a class are passed over. An address scores the mean over its characters,
its end included, of the logarithm of accepted over rejected probability.

A part of the decided addresses (``HELD_OUT``) stays out of the counts and calibrates the score: the cut is the value, on a grid of
``1 / GRID``, where the share of held-out accepted addresses at or above it exceeds that of rejected ones the most (ties: the
lowest; 0 where a class has no held-out address). Undecided addresses below the cut are blocked.

Scale: each distinct address counts once and is judged once. One pass over the characters counts the windows of ``order + 1``
characters; the models are built on distinct windows only. Addresses meet their windows' gains in a join: windows that hold over
1 / ``HOT`` of all characters (so at most ``HOT`` of them) are broadcast, all others are shuffled, none of which is frequent.

Defined cases: a null url, or one without "://", has an empty host and path, no rule, and is judged as the empty address; without
any decided address all scores are 0 and all undecided ones are allowed; repeated rows are returned each; ids may be null or repeat; other
columns are carried in ``rest``; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvest.llm._text import cut, rest_of

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
ORDER, LEAST, GRID, HOT = 4, 2, 64, 65_536
HELD_OUT = "012"                        # first hexadecimal digits of the address's md5 that keep it for the calibration
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_BROADCAST_RULES = 100_000


def address(url: Column) -> list[Column]:
    """host and path."""
    at = F.instr(url, "://")
    after = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after.substr(F.length(host) + 1, F.length(after)), r"^[^?#]*", 0)
    return [F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path")]


def with_rules(addresses: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """host, path, rule and label (the longest fitting rule and its verdict, else nulls). Every suffix of the host at a dot, with every
    beginning of the path that is as long as some rule's, is looked up by equality."""
    lengths = sorted({len(rule) - len(rule.partition("/")[0]) for _, rule in rules})
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    beginnings = F.filter(F.array(*[F.when(F.length("path") >= n, F.expr(f"left(path, {n})")) for n in lengths]).cast("array<string>"), lambda p: p.isNotNull())
    fits = F.flatten(F.transform(suffixes, lambda s: F.transform(beginnings, lambda p: F.concat(s, p))))
    table = addresses.sparkSession.createDataFrame([(r, v) for v, r in rules], "rule string, label string")
    table = F.broadcast(table) if len(rules) <= MOST_BROADCAST_RULES else table
    found = (addresses.select("host", "path", F.explode_outer(fits).alias("rule")).join(table, "rule", "left")
             .groupBy("host", "path").agg(F.max(F.when(F.col("label").isNotNull(), F.struct(F.length("rule").alias("n"), "rule", "label"))).alias("r")))
    return found.select("host", "path", "r.rule", "r.label")


def windows(addresses: DataFrame, order: int) -> DataFrame:
    """All columns, and ``window``: each character with the ``order`` characters before it."""
    chars = F.split(F.concat(F.lit(START * order), "host", "path", F.lit(END)), "")
    of_char = F.transform(F.sequence(F.lit(1), F.length(F.concat("host", "path")) + 1), lambda i: F.array_join(F.slice(F.col("chars"), i, order + 1), ""))
    return addresses.withColumn("chars", chars).withColumn("window", F.explode(of_char)).drop("chars")


def gains(counts: DataFrame, order: int, least: int) -> DataFrame:
    """window and gain: the logarithm of the accepted over the rejected probability of its last character."""
    def grams(k: int) -> DataFrame:
        return counts.groupBy(F.expr(f"right(window, {k + 1})").alias("gram")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))

    kinds = ("allow", "block")
    single = grams(0)
    totals = single.agg(F.count(F.when(F.col("allow") + F.col("block") > 0, 1)).alias("chars"), *[F.sum(k).alias(k) for k in kinds],
                        *[F.count(F.when(F.col(k) > 0, 1)).alias(f"kinds_{k}") for k in kinds]).first()
    uniform = F.lit(1.0 / (totals["chars"] + 1))
    mixed = lambda n, total, different, shorter: (n + different * shorter) / (total + different)
    now = single.select("gram", *[(mixed(F.col(k), F.lit(totals[k]), F.lit(totals[f"kinds_{k}"]), uniform) if totals[k] else uniform).alias(f"p_{k}") for k in kinds])
    for k in range(1, order + 1):
        context = Window.partitionBy(F.expr(f"left(gram, {k})"))       # as many rows as there are characters, at most
        seen = grams(k).select("gram", F.expr("substring(gram, 2)").alias("shorter"), *kinds, *[F.sum(c).over(context).alias(f"n_{c}") for c in kinds],
                               *[F.count(F.when(F.col(c) > 0, 1)).over(context).alias(f"d_{c}") for c in kinds])
        joined = seen.join(now.withColumnRenamed("gram", "shorter"), "shorter")
        now = joined.select("gram", *[F.when(F.col(f"n_{c}") >= least, mixed(F.col(c), F.col(f"n_{c}"), F.col(f"d_{c}"), F.col(f"p_{c}")))
                                      .otherwise(F.col(f"p_{c}")).alias(f"p_{c}") for c in kinds])
    return now.select(F.col("gram").alias("window"), (F.ln("p_allow") - F.ln("p_block")).alias("gain"))


def scored(addresses: DataFrame, order: int, least: int, hot: int) -> DataFrame:
    """All columns of the distinct addresses (host, path, rule, label, held_out) and ``score``."""
    place = windows(addresses.select("host", "path", F.when(~F.col("held_out"), F.col("label")).alias("of")), order)
    counts = cut(place.groupBy("window").agg(*[F.count(F.when(F.col("of") == k, 1)).alias(k) for k in ("allow", "block")], F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    gain = counts.select("window", "n").join(gains(counts, order, least), "window")
    gain = cut(gain)
    frequent = F.broadcast(gain.where(F.col("n") * hot > total).select("window", "gain"))       # fewer than ``hot`` rows
    places = windows(addresses.select("host", "path"), order)
    sums = [F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("n")]
    often = places.join(frequent, "window").groupBy("host", "path").agg(*sums)
    rarely = places.join(frequent, "window", "left_anti").join(gain.where(F.col("n") * hot <= total).select("window", "gain"), "window").groupBy("host", "path").agg(*sums)
    both = often.unionByName(rarely).groupBy("host", "path").agg(F.round(F.sum("gain") / F.sum("n"), 9).alias("score"))
    return addresses.join(both, ["host", "path"])


def calibrated(judged: DataFrame, grid: int) -> float:
    """The cut that tells the held-out addresses apart best; a score's mean of bounded gains leaves a bounded number of grid values."""
    of = [F.count(F.when(F.col("label") == k, 1)).alias(k) for k in ("allow", "block")]
    bins = judged.where("held_out AND label IS NOT NULL").groupBy(F.floor(F.col("score") * grid).alias("bin")).agg(*of).orderBy(F.desc("bin")).collect()
    allowed, blocked = sum(b["allow"] for b in bins), sum(b["block"] for b in bins)
    if not allowed or not blocked:
        return 0.0
    best, at, kept, let_through = 0, bins[0]["bin"] + 1, 0, 0       # at first, none at or above the cut
    for b in bins:
        kept, let_through = kept + b["allow"], let_through + b["block"]
        if kept * blocked - let_through * allowed >= best:
            best, at = kept * blocked - let_through * allowed, b["bin"]
    return at / grid


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url", order: int = ORDER, least: int = LEAST,
           grid: int = GRID, hot: int = HOT) -> DataFrame:
    """rest (all columns), host, path, rule, verdict and score of each row."""
    rows = pages.select(rest_of(pages), F.col(url).cast("string").alias("url")).select("rest", *address(F.col("url")))
    distinct = with_rules(rows.groupBy("host", "path").agg(F.lit(1).alias("one")), rules)
    distinct = cut(distinct.withColumn("held_out", F.md5(F.concat("host", "path").cast("binary")).substr(1, 1).isin(*HELD_OUT)))
    of_address = cut(scored(distinct, order, least, hot))
    least_score = calibrated(of_address, grid)
    verdict = F.coalesce("label", F.when(F.col("score") < least_score, "block").otherwise("allow"))
    return rows.join(of_address.select("host", "path", "rule", verdict.alias("verdict"), "score"), ["host", "path"], "left").select(
        "rest", "host", "path", "rule", "verdict", "score")


def digest(found: DataFrame) -> DataFrame:
    return found.select("rest.page_id", "host", "path", "rule", "verdict")


def oracle(rules: Sequence[tuple[str, str]] = RULES, order: int = ORDER, least: int = LEAST, grid: int = GRID) -> str:
    """The same verdicts in DuckDB SQL."""
    table = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '{r[len(r.partition('/')[0]):]}')" for v, r in rules)
    parts = [f"""rules(label, rule, rh, rp) AS (VALUES {table}),
      u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
      v AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM u),
      w AS (SELECT page_id, coalesce(translate(h, '{UPPER}', '{LOWER}'), '') AS host, coalesce(regexp_extract(substr(rest, length(h) + 1), '^[^?#]*'), '') AS path FROM v),
      d AS (SELECT DISTINCT host, path FROM w),
      fits AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(label, length(rule)) AS label FROM d JOIN rules ON
        (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path),
      a AS (SELECT d.host, d.path, rule, label, substr(md5(d.host || d.path), 1, 1) IN ({", ".join(f"'{x}'" for x in HELD_OUT)}) AS held_out
        FROM d LEFT JOIN fits f ON d.host = f.host AND d.path = f.path),
      pad AS (SELECT host, path, CASE WHEN NOT held_out THEN label END AS k, repeat(chr(2), {order}) || host || path || chr(3) AS t FROM a),
      places AS (SELECT host, path, k, substr(t, i::INT, {order + 1}) AS win FROM (SELECT *, unnest(range(1, length(t) - {order} + 1)) AS i FROM pad)),
      counts AS (SELECT win, count(*) FILTER (k = 'allow') AS a, count(*) FILTER (k = 'block') AS b FROM places GROUP BY win),
      g0 AS (SELECT right(win, 1) AS gram, sum(a) AS a, sum(b) AS b FROM counts GROUP BY 1),
      tot AS (SELECT 1.0::DOUBLE / (count(*) FILTER (a + b > 0) + 1) AS u, sum(a) AS na, sum(b) AS nb, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM g0),
      p0 AS (SELECT gram, CASE WHEN na > 0 THEN (a + da * u) / (na + da) ELSE u END AS pa, CASE WHEN nb > 0 THEN (b + db * u) / (nb + db) ELSE u END AS pb FROM g0, tot)"""]
    for k in range(1, order + 1):
        parts.append(f"""g{k} AS (SELECT right(win, {k + 1}) AS gram, sum(a) AS a, sum(b) AS b FROM counts GROUP BY 1),
          s{k} AS (SELECT *, sum(a) OVER c AS na, sum(b) OVER c AS nb, count(*) FILTER (a > 0) OVER c AS da, count(*) FILTER (b > 0) OVER c AS db FROM g{k}
            WINDOW c AS (PARTITION BY left(gram, {k}))),
          p{k} AS (SELECT s.gram, CASE WHEN na >= {least} THEN (a + da * pa) / (na + da) ELSE pa END AS pa, CASE WHEN nb >= {least} THEN (b + db * pb) / (nb + db) ELSE pb END AS pb
            FROM s{k} s JOIN p{k - 1} p ON substr(s.gram, 2) = p.gram)""")
    parts.append(f"""score AS (SELECT host, path, round(sum(ln(pa) - ln(pb)) / count(*), 9) AS score FROM places JOIN p{order} ON win = gram GROUP BY host, path),
      bins AS (SELECT floor(score * {grid})::BIGINT AS bin, count(*) FILTER (label = 'allow') AS a, count(*) FILTER (label = 'block') AS b
        FROM a JOIN score USING (host, path) WHERE held_out AND label IS NOT NULL GROUP BY 1),
      sums AS (SELECT bin, sum(a) OVER (ORDER BY bin DESC) AS ka, sum(b) OVER (ORDER BY bin DESC) AS kb, sum(a) OVER () AS ta, sum(b) OVER () AS tb FROM bins
        UNION ALL SELECT max(bin) + 1, 0, 0, sum(a), sum(b) FROM bins),
      best AS (SELECT bin FROM sums WHERE ta > 0 AND tb > 0 ORDER BY ka * tb - kb * ta DESC, bin LIMIT 1),
      least AS (SELECT coalesce((SELECT bin FROM best), 0) / {float(grid)}::DOUBLE AS least)""")
    return f"""WITH {", ".join(parts)}
      SELECT page_id, w.host, w.path, a.rule, coalesce(a.label, CASE WHEN s.score < least.least THEN 'block' ELSE 'allow' END) AS verdict
      FROM w JOIN a ON w.host = a.host AND w.path = a.path JOIN score s ON w.host = s.host AND w.path = s.path, least"""
