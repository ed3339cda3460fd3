"""DuckDB SQL text for the fixture views (independent re-statement of the
Spark column library, used only by the correctness oracle).

DuckDB uses RE2; the patterns below are written for RE2 directly.
"""
from __future__ import annotations

import unicodedata

# --- Fixed values, stated for the oracle on its own: nothing here is imported
# from the code under test.
NUMERIC_FEATURES = """url_len dom_len is_ip tld_len subdom_cnt letter_cnt digit_cnt special_cnt eq_cnt qm_cnt amp_cnt dot_cnt
    dash_cnt under_cnt letter_ratio digit_ratio spec_ratio is_https slash_cnt entropy path_len query_len""".split()
CHAR_COUNTS = {"eq_cnt": "=", "qm_cnt": "?", "amp_cnt": "&", "dot_cnt": ".", "dash_cnt": "-", "under_cnt": "_", "slash_cnt": "/"}
TWO_LABEL_SUFFIXES = ["uk", "au", "jp", "nz", "za"]
SECOND_LEVEL_LABELS = ["co", "com", "org", "ac", "gov", "edu", "net", "nhs"]
# a dotted quad, or groups of hexadecimal digits and colons
IP_PATTERN = r"^((\p{Nd}{1,3}\.){3}\p{Nd}{1,3}|\[?[0-9A-Fa-f:]+(\.[0-9A-Fa-f:]+)*\]?)\z"
# what counts as white space at the ends: every character that Python's str.strip() removes
STRIP_CLASS = "[" + "".join(f"\\x{{{c:x}}}" for c in range(0x3001) if not chr(c).strip()) + "]"
# every character with a digit value
DIGIT_CLASS_BODY = r"\p{Nd}" + "".join(
    f"\\x{{{c:x}}}" for c in range(0x20000) if unicodedata.category(chr(c)) != "Nd" and unicodedata.digit(chr(c), None) is not None)
LOG_LOSS_EPS = 2.220446049250313e-16


def _q(items):
    return ", ".join(f"'{x}'" for x in items)


def _cnt(col: str, ch: str) -> str:
    return f"(length({col}) - length(replace({col}, '{ch}', '')))"


def _rcnt(col: str, pat: str) -> str:
    return f"(length({col}) - length(regexp_replace({col}, '{pat}', '', 'g')))"


def lexical_sql(col: str, n: str) -> list[str]:
    letters = _rcnt(col, r"\p{L}")
    digits = _rcnt(col, f"[{DIGIT_CLASS_BODY}]")
    special = _rcnt(col, r"[^\p{L}\p{N}/?=#&.\-_:]")
    out = [f"CAST({letters} AS INTEGER) AS letter_cnt", f"CAST({digits} AS INTEGER) AS digit_cnt",
           f"CAST({special} AS INTEGER) AS special_cnt"]
    out += [f"CAST({_cnt(col, ch)} AS INTEGER) AS {name}" for name, ch in CHAR_COUNTS.items()]
    for name, c in (("letter_ratio", letters), ("digit_ratio", digits), ("spec_ratio", special)):
        out.append(f"round_even({c} / greatest(1, {n}), 9) AS {name}")
    return out


def entropy_sql(src: str, key: str, col: str) -> str:
    """Per-key entropy of ``col`` via unnest + group by (a different route
    from the Spark higher-order-function version)."""
    return f"""(SELECT {key}, CASE WHEN max(n) = 0 THEN 0.0
          ELSE round_even(-sum(p * log2(p)), 9) + 0.0 END AS entropy
       FROM (SELECT {key}, any_value(n) AS n,
                    CASE WHEN any_value(n) = 0 THEN 1.0 ELSE count(*) / any_value(n) END AS p
             FROM (SELECT {key}, length(coalesce({col}, '')) AS n,
                          unnest(CASE WHEN coalesce({col}, '') = '' THEN [''] ELSE string_split(coalesce({col}, ''), '') END) AS ch
                   FROM {src})
             GROUP BY {key}, ch)
       GROUP BY {key})"""


def url_features_sql(src: str = "pages") -> str:
    """SELECT producing page_id, url, dom, tld and the 22 numeric features."""
    strip = (f"regexp_replace(regexp_replace(coalesce(url, ''), '^{STRIP_CLASS}+', ''), "
             f"'{STRIP_CLASS}+\\z', '')")
    lex = ",\n       ".join(lexical_sql("u", "length(u)"))
    feats = ",\n       ".join(f"b.{c}" for c in NUMERIC_FEATURES if c != "entropy")
    return f"""
WITH s0 AS (SELECT page_id, url, coalesce(url, '') AS u, {strip} AS r0 FROM {src}),
s1 AS (SELECT *, regexp_replace(CASE WHEN regexp_matches(r0, '^(https?|ftp)://') THEN r0
                                     ELSE 'http://' || r0 END, '[\\t\\r\\n]', '', 'g') AS raw FROM s0),
s2 AS (SELECT *, regexp_replace(regexp_extract(raw, '^[a-z]+://([^/?#]*)', 1), '^[\\s\\S]*@', '') AS hi,
              regexp_replace(regexp_extract(raw, '^[a-z]+://[^/?#]*([^?#]*)', 1), ';[^/]*\\z', '') AS path,
              regexp_extract(raw, '^[^?#]*\\?([^#]*)', 1) AS query FROM s1),
s3 AS (SELECT *, lower(CASE WHEN contains(hi, '[') THEN regexp_extract(hi, '\\[([^\\]]*)', 1)
                            ELSE regexp_extract(hi, '^[^:]*', 0) END) AS host FROM s2),
s4 AS (SELECT *, CASE WHEN starts_with(host, 'www.') THEN substr(host, 5) ELSE host END AS dft FROM s3),
s5 AS (SELECT *, string_split(dft, '.') AS parts FROM s4),
s6 AS (SELECT *, len(parts) AS np,
              CASE WHEN len(parts) < 2 THEN ''
                   WHEN len(parts) >= 3 AND parts[-1] IN ({_q(TWO_LABEL_SUFFIXES)})
                        AND parts[-2] IN ({_q(SECOND_LEVEL_LABELS)}) THEN parts[-2] || '.' || parts[-1]
                   ELSE parts[-1] END AS tld,
              CASE WHEN len(parts) < 2 THEN host ELSE dft END AS dom FROM s5),
b AS (SELECT page_id, url, dom, tld,
       CAST(length(u) AS INTEGER) AS url_len,
       CAST(length(dom) AS INTEGER) AS dom_len,
       CASE WHEN host = '' THEN 0 ELSE CAST(regexp_matches(host, '{IP_PATTERN}') AS INTEGER) END AS is_ip,
       CAST(length(tld) AS INTEGER) AS tld_len,
       CAST(greatest(0, np - 2) AS INTEGER) AS subdom_cnt,
       {lex},
       CAST(starts_with(r0, 'https://') AS INTEGER) AS is_https,
       CAST(length(path) AS INTEGER) AS path_len,
       CAST(length(query) AS INTEGER) AS query_len
     FROM s6),
e AS {entropy_sql(src, "page_id", "url")}
SELECT b.page_id, b.url, b.dom, b.tld,
       {feats},
       e.entropy
FROM b JOIN e USING (page_id)
"""


def url_parts_sql(src: str = "pages") -> str:
    """Same parse chain, exposing host/path/query."""
    sql = url_features_sql(src)
    head, _, _ = sql.rpartition("e AS (SELECT")
    return head.rstrip().rstrip(",") + """
SELECT page_id, host, path, query, CAST(starts_with(r0, 'https://') AS INTEGER) AS is_https,
       CASE WHEN host = '' THEN 0 ELSE CAST(regexp_matches(host, '""" + IP_PATTERN + """') AS INTEGER) END AS is_ip,
       dom, tld, CAST(greatest(0, np - 2) AS INTEGER) AS subdom_cnt
FROM s6
"""


def view(name: str, body: str) -> str:
    return f"{name} AS ({body})"


def url_features_view() -> str:
    return view("uf", url_features_sql("pages"))


LABELLED = "lu AS (SELECT *, CAST(page_id % 7 = 0 AS INTEGER) AS label FROM uf)"
WEAK_LABELLED = "wl AS (SELECT *, CAST(is_https = 0 AND query_len > 0 AS INTEGER) AS label FROM uf)"


def labelled_docs_view() -> str:
    lex = ",\n       ".join(lexical_sql("t", "length(t)"))
    return f"""dj AS (SELECT d.doc_id, d.text, CAST(l.toxic AS INTEGER) AS label
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
ld AS (SELECT b.*, e.entropy FROM
  (SELECT doc_id, label, CAST(length(t) AS INTEGER) AS text_len, {lex}
   FROM (SELECT doc_id, label, coalesce(text, '') AS t FROM dj)) b
  JOIN {entropy_sql("dj", "doc_id", "text")} e USING (doc_id))"""


SCORE_MODELS_SQL = {
    "quantity": "l_quantity / 51.0",
    "discount": "l_discount / 0.1",
    "tax": "l_tax / 0.08",
}


def scored_view(models: list[str] | None = None, name: str = "sc") -> str:
    models = models or ["quantity"]
    parts = [f"""SELECT '{m}' AS model, CAST(l_returnflag = 'R' AS INTEGER) AS y,
       CAST({SCORE_MODELS_SQL[m]} AS DOUBLE) AS p,
       CAST(CAST({SCORE_MODELS_SQL[m]} AS DOUBLE) >= 0.5 AS INTEGER) AS yhat FROM lineitem""" for m in models]
    return f"{name} AS (" + "\nUNION ALL\n".join(parts) + ")"


def scored_models_view(name: str = "sc") -> str:
    return scored_view(list(SCORE_MODELS_SQL), name)
