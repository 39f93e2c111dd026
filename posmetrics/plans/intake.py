"""From JSON pages to clean relational rows, as column expressions only.

pages -> records -> cleaned -> checked (valid / rejected) -> one DataFrame per table
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posmetrics.functions.period import as_ntz
from posmetrics.functions.text import id_text, tidy, title_case, to_zone
from posmetrics.plans.resources import FIXED_VALUES, RESOURCES, Link, Nested, Resource
from posmetrics.sources.schemas import MONTH, TABLES

DEFAULT_ZONE = "Asia/Manila"
ERRORS = "_errors"
# text and kind (record or page) of what a row was made of; names of fields of a wrong type
BODY, KIND, TYPES = "_body", "_kind", "_types"
# names of the columns and arrays that a record has, see accepted
GIVEN = "_given"


def _parsed(pages: DataFrame, spec: Resource, column: str) -> DataFrame:
    """Every page with its records as JSON texts; no list where there is none."""
    if spec.items_key is None:
        # text that is no JSON object is no record
        one = F.when(F.get_json_object(column, "$").startswith("{"), F.array(column))
        return pages.select(F.col(column).alias("page"), one.alias("records"))
    items = F.from_json(column, f"{spec.items_key} ARRAY<STRING>, cursor STRING")[spec.items_key]
    return pages.select(F.col(column).alias("page"), items.alias("records"))


def _exploded(pages: DataFrame, resource: str, column: str) -> DataFrame:
    """One row per record, and one per unreadable page, which has only its text."""
    parsed = _parsed(pages, RESOURCES[resource], column)
    # the outer form: an inner explode would parse every page again to filter it first
    each = parsed.select("page", F.col("records").isNull().alias("_bare"), F.posexplode_outer("records"))
    told = each.filter(F.col("_bare") | F.col("pos").isNotNull())
    kind = F.when(F.col("_bare"), "page").otherwise("record")
    text = F.when(F.col("_bare"), F.col("page")).otherwise(F.coalesce("col", F.lit("null")))
    record = F.from_json("col", RESOURCES[resource].record_ddl)
    rows = told.select(kind.alias(KIND), text.alias(BODY), record.alias("r")).select(KIND, BODY, "r.*")
    return _with_lists(rows, RESOURCES[resource])


def _named(cases: list[tuple[Column, str]]) -> Column:
    """The names whose condition holds; a look for any of them spares the others."""
    none = F.array().cast("array<string>")
    if not cases:
        return none
    names = F.array_compact(F.array(*(F.when(holds, F.lit(name)) for holds, name in cases)))
    return F.when(reduce(or_, [holds for holds, _ in cases]), names).otherwise(none)


def _with_lists(rows: DataFrame, spec: Resource) -> DataFrame:
    """Arrays in place of their texts: links as texts, nested rows with all fields as text.

    ``_types`` names arrays that are no list and lists with an element that is no object.
    """
    nested = {x.array: x for x in spec.nested}
    arrays = [x.array for x in (*spec.links, *spec.nested)]
    is_list = {a: F.startswith(a, F.lit("[")) for a in arrays}
    parsed = {}
    for a in arrays:
        x = nested.get(a)
        if x is None or x.bare:
            parsed[f"_list_{a}"] = F.from_json(a, "ARRAY<STRING>")
        else:  # nothing at all where an element is no object
            parsed[f"_list_{a}"] = F.when(is_list[a], F.from_json(a, f"ARRAY<STRUCT<{x.text_ddl}>>"))
    rows = rows.withColumns(parsed)
    wrong, out = [], {}
    for a in arrays:
        each, x = F.col(f"_list_{a}"), nested.get(a)
        given = F.col(a).isNotNull() & (F.col(a) != "null")
        wrong.append((given & ~is_list[a], f"{a} is no list"))
        if x is not None:
            each = _objects(each, x) if x.bare else each
            odd = is_list[a] & (each.isNull() | F.exists(each, lambda e: e.isNull()))
            wrong.append((odd, f"{a} holds what is no object"))
        out[a] = each
    return rows.withColumns({**out, TYPES: _named(wrong)}).drop(*parsed)


def _objects(texts: Column, x: Nested) -> Column:
    """Nested rows of JSON texts of which some stand for one field of an object."""

    def row(e: Column) -> Column:
        bare = F.when(e.isNotNull(), F.to_json(F.struct(e.alias(x.bare))))
        return F.from_json(F.when(F.startswith(e, F.lit("{")), e).otherwise(bare), x.text_ddl)

    return F.transform(texts, row)


def records(pages: DataFrame, resource: str, column: str = "value") -> DataFrame:
    """One row per record of every readable page; times are text, numbers typed."""
    each = _exploded(pages, resource, column).filter((F.col(KIND) == "record") & F.col(BODY).startswith("{"))
    spec, out = RESOURCES[resource], {}
    for field in TABLES[resource].schema.fields:
        name = {column: raw for raw, column in spec.renames.items()}.get(field.name, field.name)
        if isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            out[name] = _typed(F.col(name), field.dataType, DEFAULT_ZONE)[0]
    return each.withColumns(out).drop(KIND, BODY, TYPES)


def _why_unreadable(resource: str, page: str) -> Column:
    return F.when(F.get_json_object(page, "$").isNull(), F.lit("not a JSON object")).otherwise(
        F.lit(f"no list '{RESOURCES[resource].items_key}'")
    )


def unreadable(pages: DataFrame, resource: str, column: str = "value") -> DataFrame:
    """Pages that are no JSON or lack the list of records."""
    parsed = _parsed(pages, RESOURCES[resource], column).filter(F.col("records").isNull())
    return parsed.select("page", _why_unreadable(resource, "page").alias("reason"))


def _number(text: Column, kind: T.DataType) -> Column:
    """Text as a number of that type; whole numbers may be written with a fraction of 0."""
    number = text.try_cast("double")
    if isinstance(kind, T.IntegralType):
        return F.coalesce(text.try_cast(kind), F.when(number == F.floor(number), number).cast(kind))
    return number


def _typed(text: Column, kind: T.DataType, zone: str) -> tuple[Column, str | None]:
    """A scalar of that type, and what a text that is none is called."""
    if isinstance(kind, T.TimestampNTZType):
        return to_zone(text, zone), "no time"
    if isinstance(kind, T.NumericType):
        return _number(text, kind), "no number"
    if isinstance(kind, T.BooleanType):
        return text.try_cast("boolean"), "neither true nor false"
    return text, None


def clean(
    raw: DataFrame, resource: str, now: datetime | None = None, zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Rename, type, tidy and default every column; arrays stay for the split.

    A text that is not of its field's type gives NULL, no default, and is named in
    ``_types``.
    """
    spec = RESOURCES[resource]
    back = {column: name for name, column in spec.renames.items()}
    loaded = as_ntz(now) if now else F.convert_timezone(None, F.lit(zone), F.localtimestamp())
    # typed once, in a projection of their own, and used several times
    typed, given = {}, {}
    for field in TABLES[resource].schema.fields:
        c = F.col(back.get(field.name, field.name))
        if (resource, field.name) == ("merchant", "currency"):
            c = c["code"]
        given[field.name] = c
        value, what = _typed(c, field.dataType, zone)
        if what:
            typed[f"_typed_{field.name}"] = value
    for x in spec.nested:
        typed[f"_typed_{x.array}"] = _typed_elements(x, zone)
    raw = raw.withColumns(typed)
    out, wrong = [], []
    for field in TABLES[resource].schema.fields:
        name = field.name
        c, odd = given[name], F.lit(False)
        what = _typed(c, field.dataType, zone)[1]
        if what:
            c = F.col(f"_typed_{name}")
            odd = _is_odd(given[name], c, what)
            wrong.append((odd, f"{name} is {what}"))
        if isinstance(field.dataType, T.TimestampNTZType):
            if name in spec.stamped:
                c = F.when(odd, c).otherwise(F.coalesce(c, loaded))
        elif name == "id" or name.endswith("_id"):
            c = id_text(c)
        if name in spec.tidy:
            c = tidy(c)
        if name in spec.title:
            c = title_case(c)
        if name in spec.upper:
            c = F.upper(c)
        if name in spec.defaults:
            c = F.when(odd, c).otherwise(F.coalesce(c, F.lit(spec.defaults[name])))
        if (resource, name) == ("items", "handle"):
            c = F.coalesce(c, F.col("item_name"))
        if (resource, name) == ("receipts", "id"):
            c = F.coalesce(c, F.col("receipt_number"))
        out.append(c.alias(name))
    arrays, nested = [F.col(x.array) for x in spec.links], []
    for x in spec.nested:
        pairs = F.col(f"_typed_{x.array}")
        arrays.append(F.transform(pairs, lambda p: p["typed"]).alias(x.array))
        nested.append(_odd_elements(x, pairs, zone))
    kept = [x for x in (KIND, BODY) if x in raw.columns]
    types = F.concat(_named(wrong), *nested)
    if TYPES in raw.columns:
        types = F.concat(F.col(TYPES), types)
    return raw.select(*out, *arrays, types.alias(TYPES), *kept)


def _is_odd(given: Column, typed: Column, what: str) -> Column:
    """Whether a text is not of its type; blank times are none."""
    odd = given.isNotNull() & typed.isNull()
    return odd & ~F.trim(given).isin("", "null") if what == "no time" else odd


def _kinds(x: Nested) -> dict[str, T.DataType]:
    table = TABLES[x.table].schema
    return {f.name: table[f.name].dataType if f.name in table.fieldNames() else f.dataType for f in x.fields}


def _typed_elements(x: Nested, zone: str) -> Column:
    """Nested rows as given and typed."""
    kinds = _kinds(x)

    def pair(e: Column) -> Column:
        row = F.struct(*(_typed(e[name], kind, zone)[0].alias(name) for name, kind in kinds.items()))
        return F.struct(e.alias("given"), F.when(e.isNotNull(), row).alias("typed"))

    return F.transform(x.array, pair)


def _odd_elements(x: Nested, pairs: Column, zone: str) -> Column:
    """What to call each field that some element has in a wrong type; a look for any of
    them spares the others."""
    called = {n: _typed(F.lit(None).cast("string"), kind, zone)[1] for n, kind in _kinds(x).items()}
    odd = {n: partial(_element_is_odd, n, what) for n, what in called.items() if what}
    names = [F.when(F.exists(pairs, _of_one(test)), F.lit(f"{x.array} {n} is {called[n]}")) for n, test in odd.items()]
    some = F.exists(pairs, lambda p: reduce(or_, [test(p) for test in odd.values()]))
    return F.when(some, F.array_compact(F.array(*names))).otherwise(F.array().cast("array<string>"))


def _element_is_odd(name: str, what: str, pair: Column) -> Column:
    return _is_odd(pair["given"][name], pair["typed"][name], what)


def _of_one(test: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda p: test(p)


def _rules(resource: str) -> dict[str, Column]:
    spec = RESOURCES[resource]
    # a field of a wrong type is not missing, and has been named already
    odd = lambda c: F.exists(TYPES, lambda t: t.startswith(f"{c} is "))
    rules = {f"{c} missing": F.col(c).isNull() & ~odd(c) for c in spec.required}
    for c, most in spec.lengths.items():
        rules[f"{c} longer than {most}"] = F.length(c) > most
    for c, (low, high) in spec.ranges.items():
        outside = F.col(c) < low
        rules[f"{c} out of range"] = outside if high is None else outside | (F.col(c) > high)
    for c, words in spec.members.items():
        rules[f"{c} not allowed"] = ~F.col(c).isin(*words)
    rules.update(spec.extra_rules())
    return rules


def check(cleaned: DataFrame, resource: str) -> DataFrame:
    """Add the names of all broken rules; an empty array marks a valid record."""
    broken = _named([(bad, rule) for rule, bad in _rules(resource).items()])
    found = F.concat(F.col(TYPES), broken, *RESOURCES[resource].nested_rules())
    if KIND in cleaned.columns:
        found = (
            F.when(F.col(KIND) == "page", F.array(_why_unreadable(resource, BODY)))
            .when(~F.col(BODY).startswith("{"), F.array(F.lit("not an object")))
            .otherwise(found)
        )
    return cleaned.withColumn(ERRORS, found).drop(TYPES)


def judged(
    pages: DataFrame,
    resource: str,
    now: datetime | None = None,
    zone: str = DEFAULT_ZONE,
    column: str = "value",
) -> DataFrame:
    """Cleaned and checked records, and unreadable pages, from one parse of the pages."""
    return _sealed(check(clean(_exploded(pages, resource, column), resource, now, zone), resource))


def _sealed(df: DataFrame) -> DataFrame:
    """``df`` behind a boundary that no filter is pushed below: a filter on what was parsed
    would be pushed with a copy of the parsing for each rule that it stands for."""
    whole = F.struct(*(F.col(c) for c in df.columns))
    return df.select(F.explode_outer(F.array(whole)).alias("_row")).select("_row.*")


def accepted(judged: DataFrame, given_of: str | None = None) -> DataFrame:
    """The valid records. ``given_of``, the name of their resource, adds ``_given``: the names
    of the columns and arrays that each record has, a null being one. ``updated_at`` always
    counts as given where it is set at loading."""
    good = judged.filter(F.size(ERRORS) == 0)
    if given_of:
        resource = RESOURCES[given_of]
        name = lambda k: F.coalesce(F.element_at(F.create_map(*names), k), k)
        names = [F.lit(x) for pair in (resource.renames or {"": ""}).items() for x in pair]
        given = F.transform(F.json_object_keys(BODY), name)
        stamped = [F.lit(c) for c in resource.stamped if c == "updated_at"]
        good = good.withColumn(GIVEN, F.array_union(given, F.array(*stamped).cast("array<string>")))
    return good.drop(ERRORS, KIND, BODY)


def refused(judged: DataFrame) -> DataFrame:
    """kind, body, reasons of the records and pages that are left out."""
    return judged.filter(F.size(ERRORS) > 0).select(
        F.col(KIND).alias("kind"), F.col(BODY).alias("body"), F.array_join(ERRORS, "; ").alias("reasons")
    )


def valid(checked: DataFrame) -> DataFrame:
    return accepted(checked)


def rejected(checked: DataFrame) -> DataFrame:
    """Records with broken rules, as they came, with their reasons."""
    return refused(checked).filter("kind = 'record'").select(F.col("body").alias("record"), "reasons")


def prepared(
    pages: DataFrame,
    resource: str,
    now: datetime | None = None,
    zone: str = DEFAULT_ZONE,
    column: str = "value",
) -> DataFrame:
    """Cleaned and checked records of all readable pages."""
    return judged(pages, resource, now, zone, column).filter(F.col(KIND) == "record")


def split(
    good: DataFrame, resource: str, zone: str = DEFAULT_ZONE, unique: bool = False
) -> dict[str, DataFrame]:
    """Main table first, then its junction and child tables.

    Tables of receipts also carry the month of the receipt they are stored by. ``unique``:
    of nested rows of one record with the same key, one stays: the least by a hash of its
    content, so that the choice does not depend on the batch; rows without an id all stay.
    """
    spec, main = RESOURCES[resource], TABLES[resource]
    carried = [MONTH] if MONTH in good.columns else []
    if main.by_month and not carried:
        good = good.withColumn(MONTH, month_of("receipt_date"))
        carried = [MONTH]
    if resource == "discounts":
        # checked as given, kept only where the type uses it
        for kind, column in FIXED_VALUES.items():
            good = good.withColumn(column, F.when(F.col("type") == kind, F.col(column)))
    tables = {resource: good.select(*main.columns, *carried)}
    for link in spec.links:
        tables[link.table] = _split_link(good, main.key[0], link)
    for nested in spec.nested:
        tables[nested.table] = _split_nested(good, main.key[0], nested, carried, unique)
    return tables


def month_of(column: str) -> Column:
    return F.trunc(F.to_date(column), "month")


def _split_link(good: DataFrame, key: str, link: Link) -> DataFrame:
    owner, other = TABLES[link.table].key
    return good.select(
        F.col(key).alias(owner), F.explode(F.array_distinct(link.array)).alias(other)
    ).select(owner, id_text(F.col(other)).alias(other))


def _split_nested(
    good: DataFrame, key: str, nested: Nested, carried: list[str], unique: bool
) -> DataFrame:
    table = TABLES[nested.table]

    def columns(e: Column, owner: Column, at: Column | None = None) -> list[Column]:
        out = []
        for field in table.schema.fields:
            if field.name == table.owner:
                c = owner
            elif nested.numbered and field.name == "position":
                c = at + 1
            else:
                c = e[field.name]
                if field.name in nested.defaults:
                    c = F.coalesce(c, F.lit(nested.defaults[field.name]))
            out.append(c.alias(field.name))
        return out

    elements = F.col(nested.array)
    if unique and table.may_repeat:
        hashed = lambda e: F.xxhash64(*columns(e, F.col(key)))
        elements = _first_of_each(elements, table.key[-1], hashed)
    owner = F.col(key).alias(table.owner)
    each = F.posexplode(elements).alias("_at", "_e") if nested.numbered else F.explode(elements).alias("_e")
    rows = good.select(owner, *carried, each)
    return rows.select(*columns(F.col("_e"), F.col(table.owner), F.col("_at")), *carried)


def _first_of_each(elements: Column, name: str, hashed: Callable[[Column], Column]) -> Column:
    """One element of each id, that of the least hash, and all without one; a look for any
    repetition spares the lists that have none."""
    ids = F.array_compact(F.transform(elements, lambda e: e[name]))
    told = F.transform(
        elements, lambda e, i: F.struct(e[name].alias("id"), hashed(e).alias("hash"), i.alias("at"), e.alias("e"))
    )

    def firsts(of: Column) -> Column:
        return F.filter(of, lambda t, i: t["id"].isNull() | (i == 0) | ~F.get(of, i - 1)["id"].eqNullSafe(t["id"]))

    # the one element of an array names the sorted list, which is thus sorted once
    kept = F.get(F.transform(F.array(F.sort_array(told)), firsts), F.lit(0))
    repeats = F.size(F.array_distinct(ids)) < F.size(ids)
    return F.when(repeats, F.transform(kept, lambda t: t["e"])).otherwise(elements)
