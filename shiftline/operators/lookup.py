"""Component ids by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shiftline.functions import with_exprs
from shiftline.functions.numbers import to_whole_number
from shiftline.operators.ordered import written
from shiftline.operators.skew import BROADCAST_BYTES, left_lookup


def _comparable(name: str, collation: str | None) -> str:
    return f"trim({name})" if collation is None else f"collate(trim({name}), '{collation}')"


def resolve_component(
    slots: DataFrame,
    mapping: DataFrame,
    name: str = "component",
    strict: bool = False,
    collation: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    names: DataFrame | None = None,
) -> DataFrame:
    """Add ``component_key`` and ``component_id``.

    ``component_key`` is the id that ``mapping`` (``Component``, ``ComponentID``) gives for the
    trimmed name, as text, or the trimmed name itself when there is none. ``component_id`` is the
    number in it, NULL when it is no number. So an unmapped name that is a number passes for an id,
    unless ``strict``. A name with several ids gives a row for each.

    ``names``, a written table with a column of all names that ``slots`` has, are far fewer than rows
    when they differ: each is then looked up and read as a number once, and a ``mapping`` of any size
    comes down to them.
    """
    if names is not None:
        # Grouped as they are spelled, since by a collation this would take a sort.
        spelled = names.where(f"`{name}` IS NOT NULL").select(name).distinct()
        known = resolve_component(spelled, mapping, name, strict, collation, broadcast_bytes)
        return left_lookup(slots, written(known), name, broadcast_bytes=broadcast_bytes)
    lookup = mapping.selectExpr(
        f"{_comparable('Component', collation)} AS _name", "CAST(ComponentID AS STRING) AS _id"
    ).distinct()
    # An id is read as a number once, not in every slot that has it.
    lookup = with_exprs(lookup, {"_number": to_whole_number("_id")})
    named = slots.selectExpr("*", f"{_comparable(name, collation)} AS _name")
    matched = left_lookup(named, lookup, "_name", broadcast_bytes=broadcast_bytes)
    key = f"coalesce(_id, trim(`{name}`))"
    number = "_number"
    if not strict:
        own = to_whole_number(f"trim(`{name}`)")
        number = f"CASE WHEN _id IS NOT NULL THEN _number ELSE {own} END"
    resolved = with_exprs(matched, {"component_key": key, "component_id": number})
    return resolved.drop("_name", "_id", "_number")


def unresolved_report(resolved: DataFrame, name: str = "component") -> DataFrame:
    """The different component names without an id, sorted."""
    return (
        resolved.where(f"component_id IS NULL AND `{name}` IS NOT NULL")
        .select(name)
        .distinct()
        .orderBy(name)
    )
