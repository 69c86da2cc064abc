"""Validation: schemas of items, hard and soft rules, fill of fields, keys between tables, files of selectors."""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pregonero import rules as R

#: A time with an offset or Z.
ZONED = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}([.]\d+)?)?(Z|[+-]\d{2}:?\d{2})$"
#: Known keys of a flat item: (pattern its value must match, whether it is required).
ITEM_SCHEMA = {
    "title": (r"(?s)^.+$", True), "uf": (r"^[A-Z]{2}$", False), "cep": (r"^\d{5}-?\d{3}$", False), "auction_status": ("^(" + "|".join(R.ITEM_STATUS) + ")$", True), "property_type": ("^(" + "|".join(R.ITEM_KINDS) + ")$", False),
    "scraped_at": (ZONED, True),
}


def item_schema_failures(doc: Column) -> Column:
    """DQ4: sorted names of the fields of a JSON item that are missing, don't match or are unknown (as unknown:name); a text
    that is no JSON object fails as json."""
    item = F.from_json(doc, "map<string,string>")
    value = lambda k: F.try_element_at(item, F.lit(k))
    bad = [F.when(~F.coalesce(value(k).rlike(rx), F.lit(False)) & (F.lit(needed) | value(k).isNotNull()), F.lit(k)) for k, (rx, needed) in ITEM_SCHEMA.items()]
    keys = F.transform(F.array_except(F.map_keys(item), F.array(*[F.lit(k) for k in ITEM_SCHEMA])), lambda k: F.concat(F.lit("unknown:"), k))
    whole = F.json_object_keys(F.when(F.get_json_object(doc, "$").isNotNull(), doc)).isNotNull()
    return F.when(whole, F.array_sort(F.concat(F.array_compact(F.array(*bad)), keys))).otherwise(F.array(F.lit("json")))


def _filled(rows: DataFrame, path: str) -> Column:
    """Whether a field is there and not blank; one that the table lacks isn't. A list must hold something."""
    head, _, tail = path.partition(".")
    if head not in rows.columns or (tail and tail not in rows.schema[head].dataType.names):
        return F.lit(False)
    kind = rows.select(path).schema[0].dataType.typeName()
    return F.coalesce(F.size(path) > 0 if kind == "array" else F.trim(F.col(path).cast("string")) != "", F.lit(False))


def hard_failures(items: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """DQ5: items with `failures`: title, raw_text, status, url, round (none with a minimum bid) and provenance (the page, a
    table of key and html, doesn't hold the address of the lot literally)."""
    got = items.join(pages.select(key, F.col("html").alias("__html")), key, "left")
    bid = F.coalesce(F.exists("rounds", lambda r: r["minimum_bid_brl"].isNotNull()), F.lit(False))
    checks = {
        "title": _filled(items, "title"), "raw_text": _filled(items, "address.raw_text"), "status": _filled(items, "auction_status"), "url": _filled(items, "source_lot_url"), "round": bid,
        "provenance": F.coalesce(F.col("__html").contains(F.col("source_lot_url")), F.lit(False)),
    }
    return got.withColumn("failures", F.array_compact(F.array(*[F.when(~ok, F.lit(n)) for n, ok in checks.items()]))).drop("__html")


def soft_warnings(items: DataFrame) -> Column:
    """DQ6: fields whose absence is worth a warning."""
    return F.array_compact(F.array(*[F.when(~_filled(items, f), F.lit(f)) for f in [*R.SOFT_FIELDS, "images", "documents"]]))


def item_fill(items: DataFrame) -> Column:
    """DQ7: map of each of the measured fields to 1.0 or 0.0."""
    return F.create_map(*[x for f in R.FILL_FIELDS for x in (F.lit(f), _filled(items, f).cast("double"))])


def key_violations(tables: dict[str, DataFrame], references: list[tuple[str, str, str, str]], unique: list[tuple[str, str]]) -> DataFrame:
    """DQ3: (rule, violations): rows whose reference points nowhere, and values of unique columns that occur again."""
    parts = []
    for t, c, other, k in references:
        known = tables[other].select(F.col(k).alias(c))
        lost = tables[t].select(c).where(F.col(c).isNotNull()).join(known, c, "left_anti")
        parts.append(lost.agg(F.count("*").alias("violations")).select(F.lit(f"{t}.{c}").alias("rule"), "violations"))
    for t, c in unique:
        again = tables[t].where(F.col(c).isNotNull()).groupBy(c).count().where("count > 1")
        parts.append(again.agg(F.count("*").alias("violations")).select(F.lit(f"unique {t}.{c}").alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def parse_spec(text: str) -> Any:
    """SRC12: a file of selectors as YAML where a reader for it is installed, else as JSON (which is YAML too)."""
    try:
        import yaml
    except ImportError:
        return json.loads(text)
    return yaml.safe_load(text)


def lint_selectors(spec: Any) -> list[str]:
    """DQ8: paths of what is missing or wrong in a file of selectors."""
    if not isinstance(spec, dict):
        return ["."]
    errors: list[str] = []
    need = lambda ok, path: ok or errors.append(path)
    text = lambda d, k: isinstance(d.get(k), str)

    def listing(name: str, x: Any) -> None:
        if not isinstance(x, dict):
            return errors.append(name)
        need(text(x, "url_pattern"), f"{name}.url_pattern")
        need(text(x, "card_selector"), f"{name}.card_selector")
        need(x.get("card_kind") in R.SELECTOR_KINDS, f"{name}.card_kind")
        pages = x.get("pagination")
        need(isinstance(pages, dict) and pages.get("kind") in R.PAGINATION_KINDS and isinstance(pages.get("template", ""), (str, type(None))), f"{name}.pagination")

    need(isinstance(spec.get("auctioneer_slug"), str) and spec["auctioneer_slug"].strip(), "auctioneer_slug")
    need(isinstance(spec.get("platform_hint"), (str, type(None))), "platform_hint")
    listing("listing_active", spec.get("listing_active"))
    if "listing_closed" not in spec:
        errors.append("listing_closed")
    elif spec["listing_closed"] is not None:
        listing("listing_closed", spec["listing_closed"])
    detail = spec.get("detail")
    if not isinstance(detail, dict):
        return [*errors, "detail"]
    need(text(detail, "url_pattern"), "detail.url_pattern")
    fields = detail.get("field_selectors")
    if not isinstance(fields, dict):
        return [*errors, "detail.field_selectors"]
    for f in R.SELECTOR_FIELDS:
        s = fields.get(f, "")
        if f not in fields:
            errors.append(f"detail.field_selectors.{f}")
        elif s is not None:
            need(isinstance(s, dict) and text(s, "selector"), f"detail.field_selectors.{f}.selector")
            need(isinstance(s, dict) and s.get("kind") in R.SELECTOR_KINDS, f"detail.field_selectors.{f}.kind")
    return errors
