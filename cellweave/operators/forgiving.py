"""Lookups that forgive how a place is written, as a geocoder does with free text.

Names are compared in a plain form: lower case, no accents, anything but letters and digits a
blank. Names that differ in a few letters still go together. To find them without comparing
all with all, both sides list what is left of a name when up to that many letters are left
out; two names that few edits apart have such a rest in common, so an equal join finds them,
and their distance is then computed. Digits have to agree: another number is another place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.filters import lacks_coords
from cellweave.operators.geocode import key_values, unique_places
from cellweave.schemas import PLACE_KEYS
from cellweave.sinks import written

MOST_EDITS = 1
#: Letters a name must have for each edit that is forgiven.
LETTERS_PER_EDIT = 4
#: Longer names have to be equal in their plain form: what can be left out grows with the
#: length to the power of the edits.
LONGEST = 80

# Letters with accents and what they are without.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿāăąćčďđēęěğīįłńňōőŕřśşšťţūůűųźżž"
PLAIN = "aaaaaaceeeeiiiinoooooouuuuyyaaaccddeeegiilnnoorrsssttuuuuzzz"

#: Between the names of a place. No name holds it in its plain form.
_BAR = "|"


def plain(name: Column) -> Column:
    """A name in lower case, without accents, and with single blanks for all but letters and digits."""
    bare = F.translate(F.regexp_replace(F.lower(name), r"\p{M}+", ""), ACCENTED, PLAIN)
    return F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " "))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\P{N}+", " ")


def _without_one(text: Column) -> Column:
    """What is left when one letter, digit or blank goes."""
    every = F.filter(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)) != _BAR)
    rest = F.transform(
        every, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text)))
    )
    return F.when(F.length(text) > 0, rest)


def rests(text: Column, most_edits: int, longest: int = LONGEST) -> Column:
    """The text, and what is left of it when up to ``most_edits`` letters are left out."""
    every = last = F.array(text)
    for _ in range(most_edits):
        last = F.array_distinct(F.flatten(F.transform(last, lambda x: F.coalesce(_without_one(x), F.array().cast("array<string>")))))
        every = F.array_union(every, last)
    return F.when(F.length(text) <= longest, every).otherwise(F.array(text))


def _named(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Key columns as a struct, their plain forms, and these in one text."""
    plains = [plain(F.col(f"`{name}`")) for name in keys]
    return df.select(
        "*",
        F.struct(*(F.col(f"`{name}`") for name in keys)).alias(f"{prefix}_key"),
        F.array(*plains).alias(f"{prefix}_plain"),
        F.array_join(F.array(*plains), _BAR).alias(f"{prefix}_text"),
    )


def answers(
    rows: DataFrame,
    gazetteer: DataFrame,
    keys: Sequence[str] = PLACE_KEYS,
    asks: Column | None = None,
    most_edits: int = MOST_EDITS,
    letters_per_edit: int = LETTERS_PER_EDIT,
    longest: int = LONGEST,
) -> DataFrame:
    """A gazetteer of just the places that ``rows`` ask for, as they write them: the key
    columns, ``lat``, ``lng``, ``edits`` and ``place``, the keys of the place that was found.

    A place written as in the gazetteer is found as it is. Otherwise the one with the fewest
    edits between plain forms counts, over all names together; of several, the first by its
    keys. A name is forgiven one edit for each ``letters_per_edit`` letters that all names
    have together, ``most_edits`` at most; names whose plain form is empty, or longer than
    ``longest`` letters, are not forgiven any. An edit is a letter inserted, deleted or
    replaced; digits must be the same ones in the same order. ``asks`` says which rows are
    looked up (by default, those lacking a coordinate); a null in any key column finds nothing.

    Each way to write a place is looked up once, however many rows have it. The gazetteer is
    listed with some ``length ** most_edits`` rests for each place, joined by hash and then
    compared, so raise ``most_edits`` with care.
    """
    values = key_values(keys)
    wanted = lacks_coords() if asks is None else asks
    for value in values.values():
        wanted = wanted & value.isNotNull()
    asked = written(rows.filter(wanted).select(*(value.alias(name) for name, value in values.items())).distinct())
    known = written(unique_places(gazetteer, keys))
    exact = asked.join(known, list(keys)).select(
        *keys, "lat", "lng", F.lit(0).alias("edits"), F.struct(*keys).alias("place")
    )

    other = _named(asked.join(known, list(keys), "left_anti"), keys, "asked").filter(
        F.forall("asked_plain", lambda x: x != "")
    )
    letters = F.length(F.regexp_replace("asked_text", r"\P{L}+", ""))
    forgiven = F.when(F.length("asked_text") <= longest, F.least(F.lit(most_edits), F.floor(letters / letters_per_edit))).otherwise(0)
    # Rests of the question go no further than what it is forgiven.
    shortened = F.array(*(rests(F.col("asked_text"), n, longest) for n in range(most_edits + 1)))
    probes = other.select(
        "asked_key", "asked_plain", forgiven.cast("int").alias("forgiven"), _digits(F.col("asked_text")).alias("digits"),
        F.explode(shortened[forgiven.cast("int")]).alias("rest"),
    )
    index = _named(known, keys, "place").select(
        "place_key", "place_plain", "lat", "lng", _digits(F.col("place_text")).alias("digits"),
        F.explode(rests(F.col("place_text"), most_edits, longest)).alias("rest"),
    )
    apart = sum(
        (F.levenshtein(F.col("asked_plain")[i], F.col("place_plain")[i]) for i in range(len(keys))), F.lit(0)
    )
    met = probes.join(index, ["rest", "digits"]).withColumn("edits", apart).filter("edits <= forgiven")
    best = met.groupBy("asked_key").agg(
        F.min(F.struct("edits", F.col("place_key").alias("place"), "lat", "lng")).alias("best")
    )
    similar = best.select(
        *(F.col("asked_key")[name].alias(name) for name in keys), "best.lat", "best.lng", "best.edits", "best.place"
    )
    return exact.unionByName(similar)
