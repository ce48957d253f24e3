"""Reading the groups of comma-separated lines in time linear in their length.

A pattern whose groups may themselves hold commas can be matched in many ways, and a regular
expression tries them one after the other. Here a line is cut at its commas once, and the groups are
resolved from the right: the last place where the rest of the pattern still fits is found for one
group after the other, each by one pass over the parts. As earlier groups are greedy, these last
places are those of the first match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARK = "\x1f\x1e\x1f"


def bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` computed once, however often ``use`` reads it."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def part(parts: Column, i: Column) -> Column:
    """A part by its number; NULL beyond the ends."""
    return F.when(i >= 0, F.get(parts, i))


def places(parts: Column, condition: Callable[[Column], Column]) -> Column:
    """The numbers of the parts that meet a condition."""
    return F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.coalesce(condition(i), F.lit(False)))


def last_place(parts: Column, condition: Callable[[Column], Column]) -> Column:
    return F.array_max(places(parts, condition))


def joined(parts: Column, first: Column, end: Column) -> Column:
    """The text from part ``first`` up to, but without, part ``end``."""
    return F.array_join(F.slice(parts, first + 1, end - first), ",")


def line_groups(
    line: Column,
    groups: int,
    resolve: Callable[[Column], Column],
    possible: Column,
    plain: str,
    maybe_plain: Column | None = None,
    pattern: str | None = None,
    few: Column | None = None,
) -> Column:
    """The groups of the first match anywhere in ``line`` as an array, NULL without a match.

    ``resolve``   from the line's parts between commas to the groups, in linear time.
    ``possible``  a cheap condition that every matching line meets; others are not tried.
    ``plain``     a pattern for whole lines without ambiguity, tried first: where it matches, it must
                  give the groups that ``resolve`` gives. Its fields cannot overlap, so it needs no
                  backtracking. With ``maybe_plain`` only lines that meet this condition are tried.

    ``pattern``   the full pattern, for lines that meet ``few``: those with so few parts that there are few ways to
                  match it, and trying them costs less than resolving.

    ``regexp_extract`` would run a pattern once per group: the line is rewritten once into
    its groups with a mark between them, then split. A line that itself holds the mark is
    resolved, so no text is misread. Select the result through :func:`evaluated_once` when several
    columns read it.
    """
    general = bound(F.split(line, ","), resolve)

    def rewritten(whole_pattern: str, otherwise: Column) -> Column:
        marked = F.regexp_replace(line, whole_pattern, "".join(f"{_MARK}${i}" for i in range(1, groups + 1)))
        return bound(
            marked,
            lambda text: F.when(F.startswith(text, F.lit(_MARK)), F.slice(F.split(text, _MARK), 2, groups)).otherwise(otherwise),
        )

    unmarked = ~F.contains(line, F.lit(_MARK))
    if pattern is not None:
        none = F.lit(None).cast("array<string>")
        general = F.when(unmarked & few, rewritten(rf"(?s)\A.*?{pattern}.*\z", none)).otherwise(general)
    quick = rewritten(rf"(?s)\A{plain}\z", general)
    plain_allowed = unmarked if maybe_plain is None else unmarked & maybe_plain
    return F.when(possible, F.when(plain_allowed, quick).otherwise(general))


def evaluated_once(c: Column) -> Column:
    """A costly column as the only row of an ``explode``.

    The optimizer copies a plain column into every expression and filter that
    reads it, here the whole match for each of its groups; it leaves generated
    columns alone.
    """
    return F.explode(F.array(c))
