"""Array expressions: let-binding, n-grams, multiset overlap, padding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    A plain column expression used inside a lambda is evaluated again for every array element; a lambda
    variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ngrams(tokens: Column, n_min: int, n_max: int) -> Column:
    """All sliding n-grams for n_min..n_max, joined by a blank; none where the array is too short."""

    def of_size(w: Column, n: int) -> Column:
        count = F.greatest(F.size(w) - (n - 1), F.lit(0))
        grams = F.slice(w, F.lit(1), count)
        for k in range(1, n):
            grams = F.zip_with(grams, F.slice(w, F.lit(1 + k), count), lambda a, b: F.concat(a, F.lit(" "), b))
        return grams

    sizes = range(n_min, n_max + 1)
    return let(tokens, lambda w: F.concat(*[of_size(w, n) for n in sizes]))


def repeats(items: Column) -> Column:
    """What is left of a multiset when one of each is taken away, sorted."""
    return let(F.sort_array(items), lambda s: F.filter(s, lambda x, i: x == F.get(s, i - 1)))


def numbered(items: Column) -> Column:
    """Tell equal neighbours of a sorted array apart by number (``a, a, b`` -> ``a#1, a#2, b#1``).

    A multiset becomes a set that way: find where each run of equal items starts, number within the run.
    """

    def number_runs(s: Column, starts: Column) -> Column:
        def one_run(start: Column, j: Column) -> Column:
            length = F.coalesce(F.get(starts, j + 1), F.size(s)) - start
            item = F.get(s, start)
            return F.transform(F.sequence(F.lit(1), length), lambda k: F.concat(item, F.lit("#"), k.cast("string")))

        return F.flatten(F.transform(starts, one_run))

    def of_sorted(s: Column) -> Column:
        start_or_null = F.transform(s, lambda x, i: F.when((i == 0) | (x != F.get(s, i - 1)), i))
        return let(F.array_compact(start_or_null), lambda starts: number_runs(s, starts))

    return let(items, of_sorted)


def multiset_overlap(left: Column, right: Column) -> Column:
    """Size of the multiset intersection: every item counts as often as it occurs on both sides.

    The first occurrences meet in one hashed intersection; only repeated items are sorted into runs.
    """
    first = F.size(F.array_intersect(left, right))
    again = F.size(F.array_intersect(numbered(repeats(left)), numbered(repeats(right))))
    return (first + again).cast("bigint")


def pad(ids: Column, width: int, value: int = 0) -> Column:
    return let(ids, lambda a: F.concat(a, F.array_repeat(F.lit(value), F.greatest(F.lit(width) - F.size(a), F.lit(0)))))
