"""DuckDB snippets that mirror the Spark expressions, for the oracle SQL texts.

They are independent SQL formulations of the same rules (DuckDB's own
``strip_accents``, ``regexp_*``, list lambdas), not generated from the Spark code.
"""

from __future__ import annotations

from tejado.plans.adapters import duck_cte

NUM_GUARD = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def s(x):
    return f"CAST({x} AS VARCHAR)"


def ustrip(x):
    return f"regexp_replace({s(x)}, '^\\s+|\\s+$', '', 'g')"


def nt(x):
    """SC-01."""
    folded = f"regexp_replace(strip_accents({s(x)}), '[^\\x00-\\x7F]', '', 'g')"
    return f"nullif(trim(regexp_replace(upper({folded}), '\\s+', ' ', 'g')), '')"


def num(x):
    """SC-08."""
    return f"(CASE WHEN regexp_matches({s(x)}, '{NUM_GUARD}') THEN TRY_CAST(trim({s(x)}) AS DOUBLE) END)"


def pct(x):
    """SC-09."""
    v = num(f"replace(replace({ustrip(x)}, '%', ''), ',', '.')")
    return f"(CASE WHEN abs({v}) <= 1 THEN {v} ELSE {v} / 100 END)"


def dockey(x):
    """SC-05."""
    return f"nullif(regexp_replace(replace({ustrip(x)}, '.0', ''), '[^0-9]', '', 'g'), '')"


def split_codes(x, seps="[,;|]"):
    """SC-10."""
    return (f"list_filter(list_transform(string_split_regex(coalesce({s(x)}, ''), '{seps}'), lambda p: {ustrip('p')}), "
            f"lambda p: p <> '' AND upper(p) NOT IN ('<NA>', 'NAN', 'NONE', 'NULL'))")


def client_name(cliente, nombres, apellidos):
    """SC-28."""
    full = ustrip(f"coalesce({nombres}, '') || ' ' || coalesce({apellidos}, '')")
    return f"(CASE WHEN {cliente} IS NOT NULL AND {ustrip(cliente)} <> '' THEN {cliente} ELSE {full} END)"


def type_stock(x):
    """SC-11a."""
    n = nt(x)
    return (f"(CASE WHEN {n} IS NULL THEN NULL "
            f"WHEN {n} LIKE '%DEPARTAMENTO%' OR {n} IN ('FLAT', 'DUPLEX', 'TRIPLEX') THEN "
            f"CASE WHEN {n} = 'FLAT' THEN 'departamento flat' ELSE 'departamento' END "
            f"WHEN starts_with({n}, 'ESTACIONAMIENTO') OR {n} LIKE '%COCHERA%' THEN 'estacionamiento' "
            f"WHEN {n} LIKE '%DEPOSITO%' THEN 'depósito' ELSE lower({ustrip(x)}) END)")


def type_sales(x):
    """SC-11b."""
    n = nt(x)
    return (f"(CASE WHEN {n} IS NULL THEN NULL "
            f"WHEN {n} LIKE '%DEPARTAMENTO%' OR {n} IN ('FLAT', 'DUPLEX', 'TRIPLEX') THEN 'DEPARTAMENTO' "
            f"WHEN starts_with({n}, 'ESTACIONAMIENTO') OR {n} LIKE '%COCHERA%' THEN 'ESTACIONAMIENTO' "
            f"WHEN {n} LIKE '%DEPOSITO%' THEN 'DEPÓSITO' ELSE {n} END)")


def first_row(select_sql, partition, order):
    return (f"(SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY {order}) "
            f"AS __rn FROM ({select_sql}) __q) __r WHERE __rn = 1)")


def with_ctes(views: list[str], ctes: list[tuple[str, str]]) -> str:
    """Adapter views first, then named CTE fragments in order."""
    head = duck_cte(*views).rstrip()
    if ctes:
        head += ",\n" + ",\n".join(f"{n} AS ({q})" for n, q in ctes)
    return head + "\n"


def norm_ascii(x):
    return f"coalesce({nt(x)}, '')"


def norm_alnum(x):
    """SC-03."""
    return f"trim(regexp_replace(regexp_replace({norm_ascii(x)}, '[^A-Z0-9]+', ' ', 'g'), '\\s+', ' ', 'g'))"


def inv_key(x):
    """SC-15."""
    s = f"regexp_replace({norm_ascii(x)}, '\\.0$', '')"
    s = f"regexp_replace({s}, '\\s+', '', 'g')"
    return f"regexp_replace({s}, '[^A-Z0-9\\-]', '', 'g')"


_FLEX = "([A-Z][0-9]{3})[-_ ]*0*([0-9]+)"
_CANON = "([BF][0-9]{3})-?0*([0-9]+)$"


def inv_flex(x):
    """SC-16."""
    s = inv_key(x)
    return (f"(CASE WHEN {s} = '' THEN '' WHEN regexp_matches({s}, '{_FLEX}') THEN "
            f"regexp_extract({s}, '{_FLEX}', 1) || '|' || regexp_extract({s}, '{_FLEX}', 2) "
            f"ELSE regexp_replace({s}, '[^A-Z0-9]', '', 'g') END)")


def pad0(x, n):
    return f"(CASE WHEN length({x}) < {n} THEN lpad({x}, {n}, '0') ELSE {x} END)"


def inv_canon(x):
    """SC-17."""
    s = f"regexp_replace(strip_accents(upper({ustrip(x)})), '[^\\x00-\\x7F]', '', 'g')"
    s = f"translate(regexp_replace({s}, '\\s+', '', 'g'), '_/', '--')"
    s = f"regexp_replace({s}, '[^A-Z0-9\\-]', '', 'g')"
    s = f"regexp_replace(regexp_replace({s}, '-+', '-', 'g'), '^-+|-+$', '', 'g')"
    return (f"coalesce(CASE WHEN regexp_matches({s}, '{_CANON}') THEN regexp_extract({s}, '{_CANON}', 1) || '-' || "
            f"{pad0(f'regexp_extract({s}, {chr(39)}{_CANON}{chr(39)}, 2)', 8)} ELSE {s} END, '')")


def group_of(x):
    """SC-18 (two-tier variant)."""
    from tejado.functions.keys import GROUP_ALIASES
    import unicodedata
    n = f"replace({norm_ascii(x)}, '-', '_')"
    whens = []
    for group, aliases in GROUP_ALIASES:
        for a in aliases:
            t = unicodedata.normalize("NFKD", a).encode("ascii", "ignore").decode().upper()
            t = " ".join(t.split()).replace(" ", "_")
            whens.append(f"WHEN contains({n}, '{t}') THEN '{group}'")
    return "(CASE " + " ".join(whens) + " END)"


def company_of(x):
    """SC-18 (company rules)."""
    from tejado.functions.keys import COMPANY_RULES
    from tejado.functions.text import fold_words
    key = norm_alnum(f"string_split({s(x)}, '/')[-1]")
    whens = []
    for company, sales_file, master_file, tokens in COMPANY_RULES:
        conds = [f"{key} = '{fold_words(sales_file)}'", f"{key} = '{fold_words(master_file)}'"]
        conds += [f"contains({key}, '{fold_words(t)}')" for t in tokens]
        whens.append(f"WHEN {' OR '.join(conds)} THEN '{company}'")
    return "(CASE " + " ".join(whens) + " END)"


def first_non_blank(col, order):
    return f"arg_min({col}, {order}) FILTER (WHERE {col} IS NOT NULL AND {ustrip(col)} <> '')"


def nc(x):
    """SC-02: null -> '', strip, lower, accents off."""
    return f"strip_accents(lower({ustrip(f'coalesce({s(x)}, {chr(39)}{chr(39)})')}))"


def strict_doc(x, require_len=None):
    """SC-06."""
    t = f"regexp_replace(regexp_replace(upper({ustrip(x)}), '\\.0$', ''), '[^0-9]', '', 'g')"
    t = f"nullif({t}, '')"
    return f"(CASE WHEN length({t}) = {require_len} THEN {t} END)" if require_len else t
