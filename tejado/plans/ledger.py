"""Invoice-ledger enrichment against invoice masters (JOB-08, JOB-09).

The reference loops over companies and ledger files and merges in memory.
Here the ledger is one DataFrame (every file, a company column derived from
the file name) and each tier is **one** left join on a composite key
(company or group, invoice key): Spark co-partitions both sides by the key,
and AQE splits a skewed key on the ledger side. Master rows are compacted per
key first (partial aggregation), so every join is many-to-one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tejado.functions.keys import (COMPANY_RULES, company_from_name, flex_from_exact, invoice_key, with_canonical_key, with_company,
                                   with_group, with_invoice_keys)
from tejado.functions.rules import any_not_null
from tejado.functions.text import has_text, ustrip
from tejado.operators.columns import drop_prior, find_column, place_after
from tejado.operators.joins import spread_unmatchable
from tejado.session import staged

# Names an invoice-number column may have.
INVOICE_COLUMNS = ["N° Comprobante", "Nº Comprobante", "N Comprobante", "nro_comprobante", "numero_comprobante",
                   "comprobante", "COMPROBANTE", "ID Comprobante", "id_comprobante"]
TARGETS = ["tipos_unidad_efac", "u1_tipo_efac", "u1_n_efac"]
# Master columns carried along (names by rule PRJ-06), and what they are called after the match.
EXTRAS = {"efac_proyecto": "Proyecto", "efac_estado_proyecto": "Estado Proyecto",
          "efac_descripcion_xml": "Descripcion XML", "efac_concepto": "Concepto"}
TARGET_SOURCES = {"tipos_unidad_efac": "Tipos Unidad", "u1_tipo_efac": "U1 Tipo", "u1_n_efac": "U1 N"}
CARRIED = ["efac_comprobante_raw", "efac_source_file", "efac_source_sheet", "efac_group", *EXTRAS]
AUDIT = ["efac_match_method", "efac_match_count", "efac_source_file", "efac_source_sheet"]

# Match-method labels.
EXACT = "EXACT_COMPROBANTE"
FLEX = "FLEX_SERIE_NUMERO"
SOURCE_AWARE = "SOURCE_FILE_PLUS_COMPROBANTE"


def invoice_column(df: DataFrame, given: str | None) -> str:
    """The invoice-number column: the one given, else found by name; raises if there is none."""
    found = given or find_column(df, INVOICE_COLUMNS)
    if found is None or found not in df.columns:
        raise KeyError(f"no invoice column ({given or INVOICE_COLUMNS}); available: {', '.join(df.columns)}")
    return found


def _named(df: DataFrame, sources: dict[str, str]) -> list:
    """Columns by their rule names, under their new names; absent ones are null."""
    out = []
    for new, name in sources.items():
        found = find_column(df, [name], contains=None)
        out.append((F.col(f"`{found}`").cast("string") if found else F.lit(None).cast("string")).alias(new))
    return out


def master_rows(master: DataFrame, key_col: str | None = None, file_col: str = "master_file",
                sheet_col: str = "hoja", order_col: str = "orden_fila") -> DataFrame:
    """Standardised master rows with both keys; rows with a blank exact key dropped (FLT-18)."""
    out = master.select(
        F.col(f"`{invoice_column(master, key_col)}`").cast("string").alias("efac_comprobante_raw"),
        *_named(master, TARGET_SOURCES), *_named(master, EXTRAS), F.col(file_col).alias("efac_source_file"),
        F.col(sheet_col).alias("efac_source_sheet"), F.col(order_col).alias("__ord"))
    out = with_invoice_keys(out, "efac_comprobante_raw", "efac_comp_key_exact", "efac_comp_key_flex")
    out = with_group(out, "efac_source_file", "efac_group").withColumn(
        "efac_group", F.coalesce(F.col("efac_group"), F.lit("UNKNOWN")))
    return out.where(F.col("efac_comp_key_exact") != "")


def _compact(rows: DataFrame, keys: list[str], values: list[str], extra: list | None = None) -> DataFrame:
    """AG-15 + AG-03: per key the first non-blank value of each column together with where it stood (a struct of place and
    value), and the row count ``__n``. The place is kept so that coarser keys can be made from these rows (:func:`_merge`)."""
    first = [F.min(F.when(has_text(F.col(c)), F.struct(F.col("__ord").alias("at"), F.col(c).alias("value")))).alias(c) for c in values]
    return rows.groupBy(*keys).agg(*first, F.count(F.lit(1)).alias("__n"), *(extra or []))


def _merge(parts: DataFrame, keys: list, values: list[str], extra: list | None = None) -> DataFrame:
    """The same for coarser keys, from compacted rows."""
    return parts.groupBy(*keys).agg(*[F.min(c).alias(c) for c in values], F.sum("__n").alias("__n"), *(extra or []))


def _values(columns: list[str]) -> list:
    """The values alone, of compacted columns."""
    return [F.col(f"{c}.value").alias(c) for c in columns]


def compacted_master(master: DataFrame) -> DataFrame:
    """The master rows, keys normalised once and compacted by group and exact key, as a written table of a row per exact key.

    ``entries`` holds a struct per group of the key: group, compacted columns, row count. Groups come from the fixed alias
    list, so a key has few, and what all groups say together needs no second table.
    """
    parts = _compact(master_rows(master).withColumn("__grp", F.col("efac_group")), ["__grp", "efac_comp_key_exact"],
                     TARGETS + CARRIED, [F.first("efac_comp_key_flex").alias("efac_comp_key_flex")])
    return staged(_by_key(parts, "efac_comp_key_exact", [F.first("efac_comp_key_flex").alias("efac_comp_key_flex")]), "ledger-master")


def _by_key(parts: DataFrame, key: str, extra: list | None = None) -> DataFrame:
    """Rows compacted by group and key -> (key, ``entries``): the groups of a key in one row."""
    entry = F.struct("__grp", *TARGETS, *CARRIED, "__n")
    return parts.groupBy(key).agg(F.collect_list(entry).alias("entries"), *(extra or []))


def _lookup(by_key: DataFrame, key: str) -> DataFrame:
    """(key, ``entries``) with the values alone; the group ``ALL`` has an entry of its own where a key has several groups."""
    values = TARGETS + CARRIED
    own = F.transform("entries", lambda e: F.struct(e["__grp"].alias("grp"), *[e[c]["value"].alias(c) for c in values], e["__n"].alias("n")))
    first = lambda c: F.array_min(F.transform("entries", lambda e: e[c]))["value"].alias(c)
    rows = F.aggregate("entries", F.lit(0).cast("long"), lambda n, e: n + e["__n"])
    everything = F.array(F.struct(F.lit("ALL").alias("grp"), *[first(c) for c in values], rows.alias("n")))
    return by_key.select(key, F.when(F.size("entries") > 1, F.concat(own, everything)).otherwise(own).alias("entries"))


def _entry(entries, grp) -> Column:
    """The values and row count of a group's entry, null without one; of a single entry ``ALL`` is the same."""
    mine = F.filter(entries, lambda e: (e["grp"] == grp) | ((grp == "ALL") & (F.size(entries) == 1)))
    return F.get(F.transform(mine, lambda e: F.struct(*[e[c].alias(c) for c in TARGETS + CARRIED], e["n"].alias("n"))), 0)


def lookups(compacted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact and flexible lookups (key, ``entries``) of the compacted master; a row holds what each group says, and ``ALL``.

    The flexible key depends on the exact one, so both come from the compacted rows: the master itself is read, folded
    and shuffled once. The flexible lookup is written too: the join with the ledger then deals out thin rows, and its
    sides can be split where a key is hot.
    """
    parts = compacted.select("efac_comp_key_flex", F.explode("entries").alias("__e")).select("efac_comp_key_flex", "__e.*")
    by_flex = _by_key(_merge(parts, ["__grp", "efac_comp_key_flex"], TARGETS + CARRIED), "efac_comp_key_flex")
    return _lookup(compacted, "efac_comp_key_exact"), staged(_lookup(by_flex, "efac_comp_key_flex"), "ledger-flex")


def enrich_two_tier(ledger: DataFrame, master: DataFrame, comp_col: str | None = None,
                    file_col: str = "source_file", force_all: bool = False, in_steps: bool = False) -> DataFrame:
    """JOB-08 / JN-09 / JN-11: exact key first; rows still without a method try the flexible key.

    Targets and audit columns come directly after the invoice column (PRJ-12), which is found by name if not given.
    The lookup group is the ledger file's company group, or ``ALL`` when forced,
    unknown, or when the masters hold no file of that group. ``in_steps``: the rows are written between the two joins, so
    that the disk holds the shuffles of one join at a time; for outputs of all columns (an audit needs few and stays lazy).
    """
    compacted = compacted_master(master)
    exact, flex = lookups(compacted)
    comp_col = invoice_column(ledger, comp_col)
    led = drop_prior(ledger, TARGETS + CARRIED + ["efac_match_method", "efac_match_count"])
    salt = list(led.columns)  # the ledger's own columns give each row a stable hash
    own = [c for c in led.columns if not c.endswith("_flex") and not c.startswith("__")]
    if force_all:
        grp = F.lit("ALL")
    else:
        # groups that have masters: bounded by the fixed alias list, so broadcasting it is safe
        known = F.broadcast(compacted.select(F.explode("entries.__grp").alias("__known")).distinct())
        led = with_group(led, file_col, "__g")
        led = led.join(known, on=led["__g"] == known["__known"], how="left")
        grp = F.coalesce(F.col("__known"), F.lit("ALL"))
    led = led.withColumn("__grp", grp).withColumn("__exact", invoice_key(F.col(f"`{comp_col}`")))
    # A blank key can never match (the typical hot key of a ledger): it is salted so those rows
    # spread over the shuffle instead of piling into one partition (see joins.spread_unmatchable).
    led = led.withColumn("__jx", spread_unmatchable(F.col("__exact"), salt))
    m = led.join(exact, on=led["__jx"] == exact["efac_comp_key_exact"], how="left")
    m = m.select(*[F.col(f"`{c}`") for c in own], "__grp", "__jx", _entry(F.col("entries"), F.col("__grp")).alias("__ex"))
    m = staged(m, "ledger-exact") if in_steps else m
    # the flexible key comes of the exact one, so the first join carries that alone; salted keys stay as they are
    m = m.withColumn("__flex", F.when(F.startswith("__jx", F.lit("#")), F.lit("")).otherwise(flex_from_exact("__jx")))
    m = m.withColumn("__jf", F.when(F.startswith("__jx", F.lit("#")), F.col("__jx")).otherwise(spread_unmatchable(F.col("__flex"), own)))
    m = m.join(flex, on=m["__jf"] == flex["efac_comp_key_flex"], how="left")
    m = m.withColumn("__fl", _entry(F.col("entries"), F.col("__grp")))
    m = m.select(*[F.col(f"`{c}`") for c in own], *[F.coalesce(f"__ex.{c}", f"__fl.{c}").alias(c) for c in TARGETS + CARRIED],
                 F.when(any_not_null(*[f"__ex.{c}" for c in TARGETS]), F.lit(EXACT)).alias("efac_match_method"),
                 F.coalesce("__ex.n", "__fl.n").alias("efac_match_count"))
    m = m.withColumn("efac_match_method", F.when(F.col("efac_match_method").isNull() & any_not_null(*TARGETS), F.lit(FLEX))
                     .otherwise(F.col("efac_match_method")))
    return place_after(m, comp_col, TARGETS + AUDIT)


def match_summary(enriched: DataFrame, by: list[str]) -> DataFrame:
    """AG-16: rows, matched, unmatched, match rate per group."""
    matched = F.count_if(F.col("efac_match_method").isNotNull())
    return (enriched.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), matched.alias("matched"))
                    .withColumn("unmatched", F.col("rows") - F.col("matched"))
                    .withColumn("match_rate", F.round(F.col("matched") / F.col("rows"), 6)))


# ---------------------------------------------------------------- company-aware variant

META = ["source_company", "efac_expected_master", "efac_source_file", "efac_source_sheet", "efac_match_count",
        "efac_match_method"]


def company_masters(master: DataFrame, company_col: str = "company", key_col: str | None = None,
                    file_col: str = "master_file", sheet_col: str = "hoja", order_col: str = "orden_fila") -> DataFrame:
    """JOB-09 masters: canonical key per company, compacted (count, first non-empty values, sheets in first-seen order).

    First by company, key and sheet, then by company and key: one scan, and a key's list holds a row per sheet only.
    """
    rows = master.select(
        F.col(company_col).alias("__company"), F.col(file_col).alias("efac_source_file"),
        F.nullif(ustrip(F.col(sheet_col).cast("string")), F.lit("")).alias("__sheet"),
        F.col(f"`{invoice_column(master, key_col)}`").alias("__raw"), *_named(master, TARGET_SOURCES), F.col(order_col).alias("__ord"))
    rows = with_canonical_key(rows, "__raw").drop("__raw")
    rows = rows.withColumn("__h", F.xxhash64("__company", "efac_comprobante_key"))  # first of the keys: sorts compare numbers
    values = ["efac_source_file", *TARGETS]
    keys = ["__company", "efac_comprobante_key"]
    # Blank keys go after they were grouped: Spark moves a filter by the key itself down to the scan, where it computes the
    # key anew, once per place that reads it.
    keyed = F.count_if(F.col("efac_comprobante_key") != "").alias("__keyed")
    by_sheet = _compact(rows, ["__h", *keys, "__sheet"], values, [F.min("__ord").alias("__first"), keyed]).where("__keyed > 0")
    sheets = F.array_sort(F.collect_list(F.when(F.col("__sheet").isNotNull(), F.struct("__first", "__sheet"))))
    out = _merge(by_sheet, ["__h", *keys], values, [F.nullif(F.array_join(sheets["__sheet"], " | "), F.lit("")).alias("efac_source_sheet")])
    # the company is the same in all rows of a key, and the expected master is the source file: neither is aggregated
    return out.select(*keys, F.when(has_text("__company"), F.col("__company")).alias("source_company"),
                      F.col("efac_source_file.value").alias("efac_expected_master"), *_values(values),
                      F.col("__n").alias("efac_match_count"), "efac_source_sheet")


def compacted_company_masters(master: DataFrame) -> DataFrame:
    """The masters of :func:`company_masters` as a written table, for one or several ledgers."""
    return staged(company_masters(master), "company-masters")


def enrich_by_company(ledger: DataFrame, master: DataFrame, comp_col: str = "nro_comprobante",
                      file_col: str = "source_file", table_name: str | None = None, rules=None,
                      keep_company: bool = False, masters: DataFrame | None = None) -> DataFrame:
    """JOB-09 / JN-10: one left join on (company, canonical key).

    The company comes from the row's source file; a ledger without that column belongs to the company that its own
    name tells (``table_name``, else its file's name). ``rules``: company rules in place of ``COMPANY_RULES``. ``masters``:
    ``master`` as compacted before (:func:`compacted_company_masters`), where several ledgers are matched with it. Rows whose
    company is unknown, or has no master, stay unmatched with empty audit columns. New columns come directly after the
    invoice column. Row order is not kept; callers sort at the sink (WD-06).
    """
    rules = rules or COMPANY_RULES
    led = drop_prior(ledger, TARGETS + META + ["efac_comprobante_key", "__company_to_match"])
    comp_col = invoice_column(led, comp_col)
    salt = list(led.columns)
    if file_col in led.columns:
        led = with_company(led, file_col, "__company", rules)
    else:
        name = F.lit(table_name) if table_name else F.col("_metadata.file_name")
        led = led.withColumn("__company", company_from_name(name, rules))
    led = with_canonical_key(led, comp_col, "efac_comprobante_key")
    masters = compacted_company_masters(master) if masters is None else masters  # read twice below
    # companies holding a master, restricted to the rule list (a ledger company always comes from it), so the broadcast
    # side has at most len(rules) rows
    have = F.broadcast(masters.select(F.col("__company").alias("__have")).distinct()
                       .where(F.col("__have").isin([c for c, _s, _m, _t in rules])))
    led = led.join(have, on=led["__company"] == have["__have"], how="left")
    # The join goes by a hash first, so sorting compares numbers and no second copy of the key is shuffled. Blank keys and
    # companies without a master never match: their hash is one of the whole row, which spreads them over the shuffle.
    unmatchable = (F.col("efac_comprobante_key") == "") | F.col("__have").isNull()
    led = led.withColumn("__h", F.when(unmatchable, F.xxhash64(*[F.col(f"`{c}`") for c in salt]))
                         .otherwise(F.xxhash64("__have", "efac_comprobante_key")))
    mk = masters.withColumnRenamed("__company", "__mc").withColumnRenamed("efac_comprobante_key", "__mk") \
                .withColumn("__mh", F.xxhash64("__mc", "__mk"))
    out = led.join(mk, on=[led["__h"] == mk["__mh"], led["__have"] == mk["__mc"], led["efac_comprobante_key"] == mk["__mk"]],
                   how="left").drop("__mc", "__mk", "__mh", "__h")
    known = F.col("__have").isNotNull()
    out = out.withColumn("efac_match_method", F.when(any_not_null(*TARGETS), F.lit(SOURCE_AWARE)))
    out = out.withColumn("source_company", F.when(known, F.coalesce("source_company", "__have")))
    out = out.withColumn("efac_expected_master",
                         F.when(known, F.coalesce(F.col("efac_expected_master"), F.element_at(_masters_of(rules), F.col("__have")))))
    out = place_after(out.drop("__have"), comp_col, [*TARGETS, *META, "efac_comprobante_key"])
    return out if keep_company else out.drop("__company")


def _masters_of(rules):
    return F.create_map(*[x for company, _s, mfile, _t in rules for x in (F.lit(company), F.lit(mfile))])


def company_audit(enriched: DataFrame, table: str | None = "tablon_file", name: str = "ledger", rules=None) -> DataFrame:
    """AG-16 (company-aware): per table and company (``SIN_COMPANY`` when unknown) rows, matched, rate, expected master.

    Takes the output of ``enrich_by_company(..., keep_company=True)``. ``table``: the column that tells the ledger
    tables apart; None: all rows are of the table ``name``.
    """
    tagged = enriched.withColumn("__c", F.coalesce(F.col("__company"), F.lit("SIN_COMPANY"))) \
                     .withColumn("__t", F.col(table) if table else F.lit(name))
    out = match_summary(tagged, ["__t", "__c"])
    return out.select(F.col("__t").alias("tablon_file"), F.col("__c").alias("source_company"),
                      F.col("rows"), F.col("matched").alias("matched_rows"), F.col("unmatched").alias("unmatched_rows"),
                      "match_rate", F.element_at(_masters_of(rules or COMPANY_RULES), F.col("__c")).alias("expected_master"))


def majority_company(ledger: DataFrame, file_col: str = "source_file") -> DataFrame:
    """AG-24: the most frequent company of a table's ``source_file`` values (ties: name order)."""
    tagged = with_company(ledger.select(file_col), file_col, "company")
    counts = tagged.where(F.col("company").isNotNull()).groupBy("company").agg(F.count(F.lit(1)).alias("n"))
    # most rows first, then the smaller name
    return counts.agg(F.min_by("company", F.struct((-F.col("n")).alias("a"), F.col("company").alias("b")))
                       .alias("company"), F.max("n").alias("rows"))
