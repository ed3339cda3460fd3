"""URL feature extraction as Spark column expressions.

Everything here is a JVM-side expression: no Python runs per row. The
features are staged in three ``select`` layers (clean -> parse -> count) so
the regex chain that finds the host is evaluated once per row and reused by
``dom``/``tld``/``is_ip``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values that must equal the reference for identical results -------
# Order of the 22 numeric features (training/serving column order).
NUMERIC_FEATURES = [
    "url_len", "dom_len", "is_ip", "tld_len", "subdom_cnt",
    "letter_cnt", "digit_cnt", "special_cnt",
    "eq_cnt", "qm_cnt", "amp_cnt", "dot_cnt", "dash_cnt", "under_cnt",
    "letter_ratio", "digit_ratio", "spec_ratio",
    "is_https", "slash_cnt", "entropy", "path_len", "query_len",
]
CATEGORICAL_FEATURES = ["tld"]
ALL_FEATURE_COLUMNS = NUMERIC_FEATURES + CATEGORICAL_FEATURES
DOUBLE_FEATURES = ["letter_ratio", "digit_ratio", "spec_ratio", "entropy"]
# Country suffixes that take a two-label TLD, and the second-level labels
# that qualify (e.g. co.uk, gov.au).
TWO_LABEL_SUFFIXES = ["uk", "au", "jp", "nz", "za"]
SECOND_LEVEL_LABELS = ["co", "com", "org", "ac", "gov", "edu", "net", "nhs"]
# Single characters counted one by one.
CHAR_COUNTS = {"eq_cnt": "=", "qm_cnt": "?", "amp_cnt": "&", "dot_cnt": ".",
               "dash_cnt": "-", "under_cnt": "_", "slash_cnt": "/"}
# Schemes accepted as-is; anything else gets "http://" prepended.
SCHEME_PATTERN = r"^(https?|ftp)://"
# IPv4 dotted quad, or the permissive IPv6-ish alternative (also matches
# hex-only names such as cafe.de), anchored at both ends.
IP_PATTERN = (r"^(?:(?:\p{Nd}{1,3}\.){3}\p{Nd}{1,3}"
              r"|\[?[0-9a-fA-F:]+(?:\.[0-9a-fA-F:]+)*\]?)\z")
# Characters removed by str.strip(): Unicode White_Space plus \x1c-\x1f.
STRIP_CLASS = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
               r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
ROUND_DIGITS = 9
# ---------------------------------------------------------------------------



def _non_decimal_digits() -> str:
    """Regex class body for characters Python's ``str.isdigit`` accepts
    beyond decimal digits (superscripts, circled digits, ...), derived from
    the Unicode database by rule rather than listed by hand."""
    import sys
    import unicodedata  # noqa: F401  (str methods use it)
    cps = [c for c in range(sys.maxunicode + 1) if chr(c).isdigit() and not chr(c).isdecimal()]
    ranges, start, prev = [], None, None
    for c in cps:
        if start is None:
            start = prev = c
        elif c == prev + 1:
            prev = c
        else:
            ranges.append((start, prev))
            start = prev = c
    if start is not None:
        ranges.append((start, prev))
    return "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)


def _nfkc_delimiters() -> str:
    """Regex class body of the characters whose NFKC form holds a URL delimiter (a netloc
    with one of them would split differently after normalisation), by rule."""
    import unicodedata
    found = [c for c in map(chr, range(0x80, 0x10000)) if not "\ud800" <= c <= "\udfff"
             and any(d in unicodedata.normalize("NFKC", c) for d in "/?#@:")]
    return "".join(f"\\x{{{ord(c):x}}}" for c in found)


NFKC_DELIMITERS = _nfkc_delimiters()
# A bracketed host: an IPv6 address (hexadecimal groups, at least two colons,
# perhaps an IPv4 tail and a zone) or a later version's literal.
IP_LITERAL = r"^\[(?:(?=(?:[^\]]*:){2})[0-9a-fA-F:]+(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3})?(?:%[^\]]+)?|[vV][0-9a-fA-F]+\.[^\]]+)\](?::[^\]]*)?\z"
# Characters counted as digits: decimal digits plus the other isdigit() characters.
EXTRA_DIGIT_CLASS_BODY = _non_decimal_digits()   # all of them are in \p{No}
DIGIT_CLASS_BODY = r"\p{Nd}" + EXTRA_DIGIT_CLASS_BODY
# Runs of characters that are NOT counted; removing them leaves exactly the
# counted characters (one regex match per run instead of one per character).
NOT_LETTER_RUN = r"[^\p{L}]+"
NOT_DIGIT_RUN = f"[^{DIGIT_CLASS_BODY}]+"
NOT_DECIMAL_RUN = r"[^\p{Nd}]+"
NOT_EXTRA_DIGIT_RUN = f"[^{EXTRA_DIGIT_CLASS_BODY}]+"
NOT_SPECIAL_RUN = r"[\p{L}\p{N}/?=#&.\-_:]+"


def _count_char(s: Column, ch: str) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))


def _count_kept(s: Column, drop_run: str) -> Column:
    return F.length(F.regexp_replace(s, F.lit(drop_run), F.lit("")))


def safe_text(c: Column) -> Column:
    """Null or non-string -> ''."""
    return F.coalesce(c.cast("string"), F.lit(""))


def strip_text(c: Column) -> Column:
    """Python ``str.strip()`` equivalent."""
    return F.regexp_replace(
        c, F.lit(f"^{STRIP_CLASS}+|{STRIP_CLASS}+\\z"), F.lit(""))


def shannon_entropy(s: Column, n: Column) -> Column:
    """Base-2 character entropy, 0 for ''. Summed in first-occurrence order.

    ``n`` is ``length(s)``; the per-character count is a native string
    replace, so no array of counts is materialised per row.
    """
    probs = F.transform(
        F.array_distinct(F.split(s, "")),
        lambda ch: (n - F.length(F.replace(s, ch, F.lit("")))) / n)
    ent = F.aggregate(probs, F.lit(0.0).cast("double"),
                      lambda acc, p: acc - p * F.log2(p))
    # + 0.0 turns the -0.0 of one-character strings into 0.0
    return F.when(n == 0, F.lit(0.0)).otherwise(F.bround(ent, ROUND_DIGITS) + F.lit(0.0))


def text_entropy(s: Column) -> Column:
    """Entropy for long texts: Arrow-batched pandas UDF, one counting pass per text.

    The column-expression version costs O(len x distinct chars) string
    rewrites per row, which dominates on multi-kilobyte documents; URLs keep
    the JVM version (:func:`shannon_entropy`).
    """
    from .arrow_udfs import char_entropy
    return char_entropy(s)


def lexical_counts(s: Column, n: Column) -> dict[str, Column]:
    """Character-level counts and ratios of a text."""
    letters = _count_kept(s, NOT_LETTER_RUN)
    # Decimal digits with a one-property class; the long class of other
    # isdigit() characters only runs on texts that contain some \p{No}.
    digits = _count_kept(s, NOT_DECIMAL_RUN) + F.when(
        s.rlike(r"\p{No}"), _count_kept(s, NOT_EXTRA_DIGIT_RUN)).otherwise(F.lit(0))
    special = _count_kept(s, NOT_SPECIAL_RUN)
    denom = F.greatest(F.lit(1), n)
    out = {"letter_cnt": letters, "digit_cnt": digits, "special_cnt": special}
    for name, ch in CHAR_COUNTS.items():
        out[name] = _count_char(s, ch)
    out["letter_ratio"] = F.bround(letters / denom, ROUND_DIGITS)
    out["digit_ratio"] = F.bround(digits / denom, ROUND_DIGITS)
    out["spec_ratio"] = F.bround(special / denom, ROUND_DIGITS)
    return out


def _parse_layer(u: Column) -> dict[str, Column]:
    """Columns derived from the cleaned URL ``_u``."""
    r0 = strip_text(u)
    prefixed = F.when(r0.rlike(SCHEME_PATTERN), r0).otherwise(F.concat(F.lit("http://"), r0))
    raw = F.regexp_replace(prefixed, F.lit(r"[\t\r\n]"), F.lit(""))
    netloc = F.regexp_extract(raw, r"^[a-z]+://([^/?#]*)", 1)
    hostinfo = F.regexp_replace(netloc, F.lit(r"^[\s\S]*@"), F.lit(""))
    host = F.lower(
        F.when(hostinfo.contains("["), F.regexp_extract(hostinfo, r"\[([^\]]*)", 1))
        .otherwise(F.regexp_extract(hostinfo, r"^[^:]*", 0)))
    path = F.regexp_replace(
        F.regexp_extract(raw, r"^[a-z]+://[^/?#]*([^?#]*)", 1), F.lit(r";[^/]*\z"), F.lit(""))
    query = F.regexp_extract(raw, r"^[^?#]*\?([^#]*)", 1)
    # Q10: a standard URL parser rejects these hosts; we keep the row and flag it.
    bad = (F.when(netloc.contains("[") != netloc.contains("]"), F.lit("invalid_ipv6_netloc"))
           .when(netloc.contains("[") & ~hostinfo.rlike(IP_LITERAL), F.lit("invalid_ip_literal"))
           .when(netloc.rlike(f"[{NFKC_DELIMITERS}]"), F.lit("netloc_changes_under_nfkc")))
    return {
        "_host": host, "_path": path, "_query": query,
        "is_https": r0.startswith("https://").cast("int"),
        "odd_scheme": (~r0.rlike(SCHEME_PATTERN) & r0.rlike(r"(?i)^(https?|ftp)://")).cast("int"),
        "url_error": bad,
    }


def _host_layer(host: Column) -> dict[str, Column]:
    """Domain and TLD rules on the parsed host."""
    dft = F.when(host.startswith("www."), F.substring(host, 5, 1 << 30)).otherwise(host)
    parts = F.split(dft, r"\.", -1)
    n = F.size(parts)
    last = F.element_at(parts, -1)
    prev = F.when(n >= 2, F.element_at(parts, -2))
    two_label = (n >= 3) & last.isin(*TWO_LABEL_SUFFIXES) & prev.isin(*SECOND_LEVEL_LABELS)
    tld = F.when(n < 2, F.lit("")).when(two_label, F.concat(prev, F.lit("."), last)).otherwise(last)
    dom = F.when(n < 2, host).otherwise(dft)
    is_ip = F.when(host == "", F.lit(0)).otherwise(host.rlike(IP_PATTERN).cast("int"))
    return {"dom": dom, "tld": tld, "is_ip": is_ip,
            "subdom_cnt": F.greatest(F.lit(0), n - 2)}


def with_url_parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``_u`` (safe URL), ``_host _path _query`` and the host-derived
    columns. Internal columns start with ``_``."""
    base = df.withColumn("_u", safe_text(F.col(url_col)))
    parsed = base.select("*", *[c.alias(k) for k, c in _parse_layer(F.col("_u")).items()])
    return parsed.select("*", *[c.alias(k) for k, c in _host_layer(F.col("_host")).items()])


def with_url_features(df: DataFrame, url_col: str = "url", keep_parts: bool = False,
                      quality_columns: bool = False) -> DataFrame:
    """Every input column plus ``dom``, ``tld`` and the 22 numeric features.

    Works unchanged on batch and streaming DataFrames.
    """
    parts = with_url_parts(df, url_col)
    u = F.col("_u")
    n = F.length(u)
    counts = lexical_counts(u, n)
    feats = {
        "url_len": n,
        "dom_len": F.length("dom"),
        "tld_len": F.length("tld"),
        **counts,
        "entropy": shannon_entropy(u, n),
        "path_len": F.length("_path"),
        "query_len": F.length("_query"),
    }
    out = parts.select("*", *[c.alias(k) for k, c in feats.items()])
    keep = [c for c in df.columns if c not in ALL_FEATURE_COLUMNS and c != "dom"]
    cols = keep + ["dom"] + ALL_FEATURE_COLUMNS
    if keep_parts:
        cols += ["_host", "_path", "_query"]
    if quality_columns:
        cols += ["odd_scheme", "url_error"]
    return out.select(*cols).withColumnsRenamed(
        {"_host": "host", "_path": "path", "_query": "query"} if keep_parts else {})


def with_text_features(df: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """Lexical counts, ratios and entropy of any text column (whole text)."""
    s = safe_text(F.col(text_col))
    n = F.length(s)
    feats = {"text_len": n, **lexical_counts(s, n), "entropy": text_entropy(s)}
    return df.select("*", *[c.alias(prefix + k) for k, c in feats.items()])


TEXT_FEATURES = ["text_len", "letter_cnt", "digit_cnt", "special_cnt", *CHAR_COUNTS.keys(),
                 "letter_ratio", "digit_ratio", "spec_ratio", "entropy"]


def display_name(feature: Column) -> Column:
    """P17: 'tld_' prefix -> 'TLD: ', else snake_case -> Title Case."""
    return F.when(feature.startswith("tld_"), F.replace(feature, F.lit("tld_"), F.lit("TLD: "))) \
        .otherwise(F.initcap(F.replace(feature, F.lit("_"), F.lit(" "))))
