"""Scalar rules as DuckDB expressions, for the statements the queries are compared with."""

from __future__ import annotations

FLOAT = r"[+-]?(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?"


def number(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '{FLOAT}') THEN TRY_CAST(replace(trim({x}), '_', '') AS DOUBLE) END"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def collapse(x: str, at_least: int = 1) -> str:
    return rf"regexp_replace({x}, '\s{{{at_least},}}', ' ', 'g')"


def money_invoice(x: str) -> str:
    t = rf"regexp_replace({x}, '[^\d,.\-]', '', 'g')"
    return number(f"(CASE WHEN contains({t}, '.') THEN replace({t}, ',', '') ELSE replace({t}, ',', '.') END)")


def _later(t: str) -> str:
    return number(
        f"(CASE WHEN regexp_matches({t}, '\\..*,[^.]*$') THEN replace(replace({t}, '.', ''), ',', '.') "
        f"WHEN contains({t}, ',') AND contains({t}, '.') THEN replace({t}, ',', '') ELSE replace({t}, ',', '.') END)"
    )


def money_silver(x: str) -> str:
    return _later(f"replace(trim({x}), ' ', '')")


def money_ocr(x: str) -> str:
    return _later(f"regexp_replace(trim({x}), '[$€£R ]', '', 'g')")


def tax_percent(x: str) -> str:
    v = number(f"replace(replace({x}, '%', ''), ',', '.')")
    return f"CASE WHEN abs({v}) <= 1 THEN ({v}) * 100 ELSE ({v}) END"


def slug(x: str) -> str:
    return f"coalesce(nullif(left(regexp_replace(upper({x}), '[^A-Z0-9]', '', 'g'), 8), ''), 'UNKNOWN')"


def clean_party(x: str) -> str:
    t = rf"regexp_replace({x}, '^\s*invoice\s*#?\s*:?\s*', '', 'i')"
    return strip(collapse(rf"regexp_replace({t}, '^\s*\d+\s+', '')"))


def token_with_digit(x: str) -> str:
    tokens = f"regexp_extract_all(upper({x}), '[A-Z0-9\\-]+')"
    return f"list_filter({tokens}, lambda w: regexp_matches(w, '[0-9]'))[1]"


def ymd(x: str) -> str:
    g = lambda n: rf"regexp_extract({x}, '(\d{{1,2}})[/\-](\d{{1,2}})[/\-](\d{{2,4}})', {n})"
    year = f"(CASE WHEN length({g(3)}) = 2 THEN '20' || {g(3)} ELSE lpad({g(3)}, 4, '0') END)"
    return f"(CASE WHEN {g(3)} <> '' THEN {year} || lpad({g(2)}, 2, '0') || lpad({g(1)}, 2, '0') END)"


def stem(x: str) -> str:
    return rf"regexp_extract({x}, '([^/]+?)(\.[^./]*)?/*$', 1)"


def number_tail(x: str) -> str:
    t = rf"regexp_replace({x}, '^\s*invoice\s*(?:no\.?|number|#)\s*[:#]?\s*', '', 'i')"
    return f"nullif({strip(collapse(rf'''regexp_extract({strip(t)}, '^\s*\S+\s+(.+)$', 1)'''))}, '')"


def merchant(x: str) -> str:
    return f"nullif(upper({strip(collapse(rf'''regexp_replace({x}, '[^A-Za-z0-9\s\-&''.]', ' ', 'g')'''))}), '')"


def number_token(x: str) -> str:
    digits = rf"regexp_replace(regexp_extract({x}, '^\s*([0-9][0-9\-\s]{{0,80}})', 1), '[\s\-]', '', 'g')"
    token = r"([A-Za-z0-9][A-Za-z0-9\-]{1,80})"
    return (
        f"upper(coalesce(CASE WHEN length({digits}) <= 40 THEN nullif({digits}, '') END, "
        rf"nullif(regexp_extract({x}, '^\s*{token}', 1), ''), nullif(regexp_extract({x}, '{token}', 1), '')))"
    )


def any_word(x: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{w}')" for w in words) + ")"


def item_name(x: str) -> str:
    letters = strip(rf"regexp_replace({x}, '[^A-Za-z\s\-''/&]', ' ', 'g')")
    return f"trim({collapse(letters, 2)}, ' .-:|,')"


def name_like(x: str) -> str:
    return f"CASE WHEN length({item_name(x)}) >= 3 THEN {item_name(x)} END"


def receipt_time(x: str) -> str:
    formats = [
        (r"\d{4}-\d\d?-\d\d? \d\d?:\d\d?:\d\d?", "%Y-%m-%d %H:%M:%S"),
        (r"\d{4}-\d\d?-\d\d? \d\d?:\d\d?", "%Y-%m-%d %H:%M"),
        (r"\d\d?/\d\d?/\d{4} \d\d?:\d\d?:\d\d?", "%m/%d/%Y %H:%M:%S"),
        (r"\d\d?/\d\d?/\d{4} \d\d?:\d\d?", "%m/%d/%Y %H:%M"),
        (r"\d\d?/\d\d?/\d{4} \d\d?:\d\d?:\d\d?", "%d/%m/%Y %H:%M:%S"),
        (r"\d\d?/\d\d?/\d{4} \d\d?:\d\d?", "%d/%m/%Y %H:%M"),
        (r"\d{4}-\d\d?-\d\d?", "%Y-%m-%d"),
        (r"\d\d?/\d\d?/\d{4}", "%d/%m/%Y"),
        (r"\d\d?/\d\d?/\d{4}", "%m/%d/%Y"),
    ]
    tries = [f"CASE WHEN regexp_full_match({x}, '{shape}') THEN try_strptime({x}, '{f}') END" for shape, f in formats]
    return f"coalesce({', '.join(tries)})"
