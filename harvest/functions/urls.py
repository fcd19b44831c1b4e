"""URL helpers (F06, F07, F13) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harvest.functions.text import let

SKIP_PARAM = "$skip"  # fixed page-offset parameter name of the portal API


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_url(col) -> tuple[Column, Column, Column]:
    """(base, query, fragment): fragment after the first '#', query between the first '?' and it."""
    u = _c(col)
    before_frag = F.regexp_extract(u, r"^([^#]*)", 1)
    frag = F.regexp_extract(u, r"^[^#]*#(.*)$", 1)
    base = F.regexp_extract(before_frag, r"^([^?]*)", 1)
    query = F.regexp_extract(before_frag, r"^[^?]*\?(.*)$", 1)
    return base, query, frag


def _quote_plus(c: Column) -> Column:
    # Java's form encoder keeps '*' and encodes '~'; form encoding as done by
    # the original keeps '~' and encodes '*'.
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _decode_plus(c: Column) -> Column:
    return F.try_url_decode(c)


def replace_url_params(col, params: dict[str, object]) -> Column:
    """set query parameters.

    The query is parsed form-style: pairs without '=' or with a blank value are
    dropped, values are decoded; parameters are regrouped by name in order of
    first appearance (repeats kept); a replaced name keeps its position, new
    names are appended in the order given; the query is re-encoded form-style
    (space -> '+'). Scheme, host, path and fragment are kept.
    """
    base, query, frag = split_url(col)
    pairs = F.filter(
        F.transform(F.split(query, "&"), lambda p: F.struct(
            F.regexp_extract(p, r"^([^=]*)=", 1).alias("k"),
            F.regexp_extract(p, r"^[^=]*=(.*)$", 1).alias("v"),
            p.contains("=").alias("has_eq"))),
        lambda s: s["has_eq"] & (s["v"] != ""))
    pairs = F.transform(pairs, lambda s: F.struct(_decode_plus(s["k"]).alias("k"), _decode_plus(s["v"]).alias("v")))
    names = F.array_distinct(F.transform(pairs, lambda s: s["k"]))
    new_names = F.array(*[F.lit(str(k)) for k in params]) if params else F.array().cast("array<string>")
    all_names = F.array_distinct(F.concat(names, new_names))

    def value_for(name: Column) -> Column:
        out = F.transform(F.filter(pairs, lambda s: s["k"] == name), lambda s: s["v"])
        for k, v in params.items():
            out = F.when(name == F.lit(str(k)), F.array(F.lit(str(v)))).otherwise(out)
        return out

    encoded = F.flatten(F.transform(all_names, lambda n: F.transform(
        value_for(n), lambda v: F.concat(_quote_plus(n), F.lit("="), _quote_plus(v)))))
    q = F.array_join(encoded, "&")
    return F.concat(base,
                    F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")),
                    F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise(F.lit("")))


def page_url(col, skip) -> Column:
    """append the page offset, with '&' when the URL already has a query."""
    u = _c(col)
    s = skip if isinstance(skip, Column) else F.lit(skip)
    sep = F.when(F.contains(u, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.concat(u, sep, F.lit(SKIP_PARAM + "="), s.cast("string"))


def fold_dots(link: Column) -> Column:
    """A link's path, which begins with a slash, without ``.`` and ``..`` segments; query and fragment stay."""
    def folded(whole: Column, path: Column) -> Column:
        parts = F.split(F.substr(path, F.lit(2)), "/")
        parts = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
        kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, part: (
            F.when(part == ".", done)
            .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .otherwise(F.concat(done, F.array(part)))))
        return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), F.substr(whole, F.length(path) + 1))).otherwise(whole)

    # most links have no dot behind a slash and are left alone
    return let(link, lambda l: F.when(F.contains(l, F.lit("/.")), let(F.regexp_extract(l, r"^([^?#]*)", 1), lambda path: folded(l, path))).otherwise(l))


def resolve_link(base_col, link_col) -> Column:
    """make a link absolute against its page URL.

    Absolute links stay; ``//host`` takes the page scheme; ``/path`` takes
    scheme and host; ``?q`` / ``#f`` attach to the page path; anything else is
    resolved against the page's directory. ``.`` and ``..`` segments are folded.
    """
    def resolved(b: Column, l: Column) -> Column:
        origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
        scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
        page = F.regexp_extract(b, r"^([^?#]*)", 1)
        page_noq = F.regexp_extract(b, r"^([^#]*)", 1)

        def in_directory(page: Column, origin: Column) -> Column:
            dir_ = F.when(F.regexp_extract(page, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*(/.*)?$", 1) == "",
                          F.concat(page, F.lit("/"))).otherwise(F.regexp_extract(page, r"^(.*/)", 1))
            return F.concat(origin, fold_dots(F.concat(F.substr(dir_, F.length(origin) + 1), l)))

        return (F.when(l.isNull(), F.lit(None).cast("string"))
                .when(l.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), l)
                .when(l.startswith("//"), F.concat(scheme, F.lit(":"), l))
                .when(l.startswith("/"), F.concat(origin, fold_dots(l)))
                .when(l == "", b)
                .when(l.startswith("?"), F.concat(page, l))
                .when(l.startswith("#"), F.concat(page_noq, l))
                .otherwise(let(page, lambda p: let(origin, lambda o: in_directory(p, o)))))

    return let(_c(link_col), lambda l: resolved(_c(base_col), l))
