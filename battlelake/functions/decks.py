"""Column functions on decks and deck patterns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from battlelake.schemas import DECK_SIZE


def pattern_of(deck: Column) -> Column:
    """Cards joined by commas, in the order given."""
    return F.concat_ws(",", deck.cast("array<string>"))


def sorted_pattern_of(deck: Column) -> Column:
    return pattern_of(F.sort_array(deck))


def pattern_cards(pattern: Column) -> Column:
    """The set of card ids of a pattern, ascending."""
    return F.sort_array(F.array_distinct(F.split(pattern, ",").cast("array<int>")))


def card_set(deck: Column) -> Column:
    return F.sort_array(F.array_distinct(deck))


def jaccard(left: Column, right: Column) -> Column:
    """Shared cards over all cards; 0 when both sets are empty."""
    shared = F.size(F.array_intersect(left, right))
    every = F.size(F.array_union(left, right))
    return F.when(every > 0, shared / every).otherwise(F.lit(0.0))


def subsets(cards: Column) -> Column:
    """All non-empty subsets of a small sorted set, each in the set's order (2^n - 1 of them)."""
    empty = F.array(F.array().cast("array<int>"))
    grown = F.aggregate(
        cards, empty,
        lambda acc, card: F.concat(acc, F.transform(acc, lambda s: F.array_append(s, card))),
    )
    return F.slice(grown, 2, F.size(grown) - 1)


def contains_all(deck: Column, cards: list[int]) -> Column:
    found = F.lit(True)
    for card in cards:
        found = found & F.array_contains(deck, card)
    return found


def contains_none(deck: Column, cards: list[int]) -> Column:
    found = F.lit(True)
    for card in cards:
        found = found & ~F.array_contains(deck, card)
    return found


def toggle(deck: Column, card: Column) -> Column:
    """Remove the card when it is in the deck, append it otherwise."""
    return F.when(F.array_contains(deck, card), F.array_remove(deck, card)).otherwise(
        F.array_append(deck, card)
    )


def bit_text(indexes: Column, width: int) -> Column:
    """Text of ``width`` digits, 1 at each index of the deck; nulls are left out, an index beyond is an error.

    Built from the gaps between the sorted indexes, so the work does not grow with width times deck size.
    """
    places = F.sort_array(F.array_distinct(F.filter(indexes, lambda i: i.isNotNull())))

    def digits(idx: Column) -> Column:
        before = lambda k: F.coalesce(F.get(idx, k - 1), F.lit(-1))
        filled = F.transform(
            idx, lambda p, k: F.concat(F.repeat(F.lit("0"), p - before(k) - 1), F.lit("1"))
        )
        highest = before(F.size(idx))
        rest = F.repeat(F.lit("0"), F.lit(width - 1) - highest)
        too_wide = F.raise_error(F.lit(f"card index beyond width {width}")).cast("string")
        return F.when(highest < width, F.concat(F.array_join(filled, ""), rest)).otherwise(too_wide)

    # The one-element array evaluates the sorted indexes once per row.
    return F.get(F.transform(F.array(places), digits), F.lit(0))


def multi_hot(indexes: Column, width: int) -> Column:
    """``array<boolean>`` of the given width, true at each index of the deck."""
    return F.split(bit_text(indexes, width), "").cast("array<boolean>")


def padded_key(indexes: Column) -> Column:
    """Each number padded to three digits and joined: text that sorts like the deck. Longer numbers stay whole."""
    padded = lambda i: F.when(i > 999, i.cast("string")).otherwise(F.lpad(i.cast("string"), 3, "0"))
    return F.array_join(F.transform(indexes, padded), "")


def file_cards(deck: Column) -> list[Column]:
    """The card columns of a file row; a deck with more cards than the row has places is an error, never cut."""
    too_long = F.raise_error(F.lit(f"a deck of more than {DECK_SIZE} cards has no place in the file"))
    whole = F.when(F.size(deck) > DECK_SIZE, too_long).otherwise(deck)
    return [F.get(whole, F.lit(i)) for i in range(DECK_SIZE)]
