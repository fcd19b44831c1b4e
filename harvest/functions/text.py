"""Scalar text helpers (F03-F05, F09-F12, F14-F24) as column expressions.

No Python UDF anywhere: every helper returns a ``Column`` that stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the original tool's for equal results.
# ---------------------------------------------------------------------------
SITE_SUFFIX = " - 農業資料開放平臺"          # removed from page titles / table names
SITE_SUFFIX_RE = r"\s*-\s*農業資料開放平臺\s*"  # title-tag form of the same suffix
MAP_PHRASE = "農地空間圖"                      # removed from table names
PDF_STRIP_CHAR = "圖"                          # dropped before matching document files
MAX_NAME_CHARS = 21                            # name length limit in characters
MAX_NAME_BYTES = 63                            # name length limit in UTF-8 bytes
ELLIPSIS_AT = 15                               # display truncation length
PROCESSED_SUFFIX = "_processed"                # child-table suffix
UPDATE_TIME_RE = r"(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})"
# Rank words for text_asc sort keys: 上 前 一 -> 1, 中 二 -> 2, 下 後 三 -> 3.
RANK_WORDS = {"上": 1, "前": 1, "一": 1, "中": 2, "二": 2, "下": 3, "後": 3, "三": 3}
# Words that route a dataset to full replacement instead of incremental load.
CODE_LIST_WORD = "代碼"
SPATIAL_WORD = "空間"
MAP_URL_FIELD = "分布圖Url"

# Java regex classes that match what Python's ``\w`` matches for text.
WORD_CLASS = r"\p{L}\p{N}_"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), lambda v: then(v)), 1)


def _fit_bytes(s: Column, max_chars: int, max_bytes: Column | int) -> Column:
    """Longest prefix of ``s`` (at most ``max_chars`` chars) within ``max_bytes`` UTF-8 bytes."""
    mb = max_bytes if isinstance(max_bytes, Column) else F.lit(max_bytes)
    out = F.lit("")
    # Ascending ladder: the last satisfied branch wins, i.e. the longest fit.
    for k in range(1, max_chars + 1):
        out = F.when(F.octet_length(F.left(s, F.lit(k))) <= mb, F.left(s, F.lit(k))).otherwise(out)
    return out


def clean_table_name(col) -> Column:
    """drop site suffix and map phrase, keep word characters, cap 21 chars / 63 bytes."""
    s = F.replace(F.replace(_c(col), F.lit(SITE_SUFFIX), F.lit("")), F.lit(MAP_PHRASE), F.lit(""))
    s = F.regexp_replace(s, f"[^{WORD_CLASS}]", "")
    return F.when(F.length(s) > MAX_NAME_CHARS, _fit_bytes(s, MAX_NAME_CHARS, MAX_NAME_BYTES)).otherwise(s)


def file_base_name(col) -> Column:
    """Last path segment."""
    return F.regexp_extract(_c(col), r"([^/]*)$", 1)


def file_extension(col) -> Column:
    """Extension as ``os.path.splitext`` sees it (leading dots never start one)."""
    return F.regexp_extract(file_base_name(col), r"^\.*[^.].*(\.[^.]*)$", 1)


def file_stem(col) -> Column:
    """base name without extension."""
    base = file_base_name(col)
    return F.left(base, F.length(base) - F.length(file_extension(col)))


def truncate_file_name(col) -> Column:
    """base name with the stem cut to 21 chars and the whole to 63 bytes."""
    base, ext, stem = file_base_name(col), file_extension(col), file_stem(col)
    room = F.lit(MAX_NAME_BYTES) - F.octet_length(ext)
    return F.when(F.length(stem) > MAX_NAME_CHARS,
                  F.concat(_fit_bytes(stem, MAX_NAME_CHARS, room), ext)).otherwise(base)


def clean_keyword(col) -> Column:
    """keep word and space characters, lower-case, trim; NULL -> ''."""
    s = F.regexp_replace(_c(col), rf"(?U)[^{WORD_CLASS}\s]", "")
    s = F.regexp_replace(F.lower(s), r"(?U)^\s+|\s+$", "")
    return F.coalesce(s, F.lit(""))


def clean_column_name(name: str) -> str:
    """space, dot and dash become underscore (a driver-side rename over df.columns)."""
    return name.replace(" ", "_").replace(".", "_").replace("-", "_")


def ellipsis(col, n: int = ELLIPSIS_AT) -> Column:
    """text longer than n characters -> first n + '...'."""
    c = _c(col)
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("..."))).otherwise(c)


def strip_title_suffix(col) -> Column:
    """F11."""
    return F.regexp_replace(_c(col), SITE_SUFFIX_RE, "")


def extract_update_time(col) -> Column:
    """first ``yyyy/MM/dd HH:mm:ss`` in the text, NULL when absent."""
    v = F.regexp_extract(_c(col), UPDATE_TIME_RE, 1)
    return F.when(v != "", v)


def right_chars(col, n: int = 7) -> Column:
    """F14."""
    return F.right(_c(col).cast("string"), F.lit(n))


def to_json_text(col) -> Column:
    """nested value -> JSON text, scalars -> their string form."""
    return F.to_json(_c(col))


def parse_json_list(col, schema: str = "array<array<string>>") -> Column:
    """F16: JSON text -> typed list; NULL where the text is not such a list."""
    return F.from_json(_c(col), schema)


def key_text(col) -> Column:
    """key value -> string, NULL stays NULL."""
    return _c(col).cast("string")


def rank_word(col) -> Column:
    """rank word -> 1/2/3, else NULL."""
    s = F.trim(_c(col).cast("string"))
    out = None
    for word, rank in RANK_WORDS.items():
        out = F.when(s == word, F.lit(rank)) if out is None else out.when(s == word, F.lit(rank))
    return out


def safe_float(col) -> Column:
    """F19."""
    return _c(col).cast("string").try_cast("double")


def compose_id(prefix, seq, width: int = 7) -> Column:
    """prefix + sequence, zero-padded to ``width`` digits; a longer sequence keeps all its digits."""
    digits = _c(seq).cast("string")
    return F.concat(_c(prefix).cast("string"), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))


def id_sequence(col, prefix_len: int) -> Column:
    """F20 (split): numeric tail after a fixed-length prefix, NULL when not digits."""
    tail = F.substring(_c(col).cast("string"), prefix_len + 1, 1 << 20)
    return F.when(tail.rlike(r"^\d+$"), tail.try_cast("bigint"))


def processed_name(col) -> Column:
    """dataset id -> processed child table name."""
    return F.concat(_c(col), F.lit(PROCESSED_SUFFIX))


def is_processed(col) -> Column:
    return F.contains(_c(col), F.lit(PROCESSED_SUFFIX))


def strip_processed(col) -> Column:
    return F.replace(_c(col), F.lit(PROCESSED_SUFFIX), F.lit(""))


def snapshot_time(col) -> Column:
    """``..._yyyyMMdd_HHmmss.json`` in a file name -> timestamp."""
    v = F.regexp_extract(_c(col), r"(\d{8}_\d{6})\.json$", 1)
    return F.try_to_timestamp(F.when(v != "", v), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")  # same zone both ways


def contains_ci(col, needle) -> Column:
    """case-insensitive substring test."""
    n = needle if isinstance(needle, Column) else F.lit(needle)
    return F.contains(F.lower(_c(col)), F.lower(n))


# The named character references that are decoded (a no-break space becomes a blank).
NAMED_REFERENCES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "amp": "&", "copy": "©", "reg": "®", "trade": "™",
    "deg": "°", "plusmn": "±", "middot": "·", "bull": "•", "hellip": "…", "ndash": "–", "mdash": "—", "lsquo": "‘",
    "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "times": "×", "divide": "÷", "euro": "€",
    "pound": "£", "yen": "¥", "sect": "§", "para": "¶", "larr": "←", "rarr": "→"}


def html_unescape(col) -> Column:
    """Decode numeric and the common named character references; others stay. The text is split at ``&``, so that
    what a reference decodes to is not read again."""
    names = F.create_map(*[F.lit(x) for pair in NAMED_REFERENCES.items() for x in pair])

    def numbered(code: Column) -> Column:
        sound = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(code == 160, F.lit(" ")).when(sound, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def char(name: Column) -> Column:
        digits = F.regexp_extract(name, r"^#[xX]?(.+)$", 1)
        code = F.when(name.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("int")
        return F.when(name.startswith("#"), let(code, numbered)).otherwise(F.element_at(names, name))

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z]{2,8});", 1)
        return F.coalesce(let(name, lambda n: F.concat(char(n), F.substr(part, F.length(n) + 2))), F.concat(F.lit("&"), part))

    def whole(parts: Column) -> Column:
        return F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, 1 << 30), decoded), ""))

    return let(_c(col), lambda s: F.when(F.contains(s, F.lit("&")), let(F.split(s, "&"), whole)).otherwise(s))


def strip_tags(col) -> Column:
    return F.regexp_replace(_c(col), r"<[^>]*>", "")


def tag_text(col) -> Column:
    """Text of an HTML fragment the way ``get_text(strip=True)`` gives it: each piece between tags is trimmed."""
    def piece(t: Column) -> Column:
        return F.regexp_replace(html_unescape(t), r"(?U)^\s+|\s+$", "")

    # text without a tag is one piece
    return let(_c(col), lambda s: F.when(F.contains(s, F.lit("<")), F.array_join(F.transform(F.split(s, r"<[^>]*>"), piece), "")).otherwise(piece(s)))
