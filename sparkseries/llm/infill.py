"""Fill-in-the-middle form of whole texts, by regular expressions with counted quantifiers.

A text is cut into units: runs of ASCII letters, or one other code point. `regexp_count` gives
their number n; two hashes of the id give the cuts a <= b among 0..n. A pattern made for the row,
with the possessive groups unit{a} and unit{b-a}, captures prefix, middle and suffix in one match,
and the replacement puts them in order behind their markers:

    psm   <P>prefix<S>suffix<M>middle        spm   <S>suffix<P>prefix<M>middle

A share of the texts stays plain, as do empty texts and texts that hold a marker; so the markers
of an output are the only ones in it, and the text can be rebuilt from output and form alone.
All is done by SQL functions, row by row, without a shuffle. Possessive groups are matched by a
loop, so a long text takes no deep recursion; memory is bounded by a row's units.

Defined results: a null text is empty, so plain; a null id is hashed as an empty one; repeated rows
get the same cut; all code points count, the ASCII letters alone form runs; an empty table gives
no rows; columns of `docs` with the names of results are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.shared import free_name

UNIT = "[A-Za-z]+|[^A-Za-z]"
MARKERS = ("<P>", "<S>", "<M>")
ADDED = ("n", "form", "prefix_chars", "middle_chars", "output")


def draws(id_: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the id's hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def quoted(marker: str) -> str:
    """A marker as a literal of a pattern and of a replacement."""
    return re.sub(r"([^A-Za-z0-9<>])", r"\\\1", marker)


def orders(markers: tuple[str, str, str]) -> dict[str, tuple[str, str, str]]:
    """Per form: replacement of a cut text, pattern of an output, replacement that rebuilds the text."""
    p, s, m = map(quoted, markers)
    return {
        "psm": (f"{p}$1{s}$3{m}$2", f"(?s)^{p}(.*?){s}(.*?){m}(.*)", "$1$3$2"),
        "spm": (f"{s}$3{p}$1{m}$2", f"(?s)^{s}(.*?){p}(.*?){m}(.*)", "$2$3$1"),
    }


def infilled(docs: DataFrame, id_: str = "doc_id", text: str = "text", plain: int = 10, spm: int = 20, seed: int = 1,
             markers: tuple[str, str, str] = MARKERS, unit: str = UNIT) -> DataFrame:
    """All rows and columns of `docs` plus n (units), form (plain, psm or spm), output, and the code
    points of prefix and middle (null if plain). `plain` and `spm` are per cent of the texts, and of
    those that are cut. `unit` must match every code point."""
    rest = [c for c in docs.columns if c not in ADDED]
    body, own, hold = (free_name([*rest, *ADDED], name) for name in ("body", "draws", "cut"))
    h = draws(F.col(id_), seed)
    rows = docs.select(*rest, F.coalesce(F.col(text), F.lit("")).alias(body)).withColumns(
        {"n": F.regexp_count(F.col(body), F.lit(unit)).cast("long"), own: F.array(*h)})
    draw = lambda k: F.get(own, F.lit(k))
    held = [F.contains(F.col(body), F.lit(m)) for m in markers]
    as_is = (F.col(body) == "") | held[0] | held[1] | held[2] | (draw(2) % 100 >= 100 - plain)
    cuts = [draw(k) % (F.col("n") + 1) for k in (0, 1)]
    rows = rows.withColumns({
        "form": F.when(as_is, "plain").when(draw(3) % 100 < spm, "spm").otherwise("psm"),
        hold: F.array(F.least(*cuts), F.greatest(*cuts))})
    first, second = F.get(hold, F.lit(0)), F.get(hold, F.lit(1))
    atom = f"(?:{_possessive(unit)})"
    pattern = F.concat(F.lit(f"(?s)^({atom}{{"), first.cast("string"), F.lit(f"}}+)({atom}{{"), (second - first).cast("string"), F.lit("}+)(.*)"))
    put = F.when(F.col("form") == "psm", orders(markers)["psm"][0]).otherwise(orders(markers)["spm"][0])
    rows = rows.withColumn("output", F.when(F.col("form") == "plain", F.col(body)).otherwise(F.regexp_replace(F.col(body), pattern, put)))
    place = {m: F.locate(m, F.col("output")) for m in markers}
    p, s, m = markers
    return rows.withColumns({
        "prefix_chars": F.when(F.col("form") == "psm", place[s] - 1 - len(p))
        .when(F.col("form") == "spm", place[m] - place[p] - len(p)).cast("long"),
        "middle_chars": F.when(F.col("form") != "plain", F.char_length("output") - place[m] + 1 - len(m)).cast("long"),
    }).select(*rest, *ADDED)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text, from an output and its form."""
    back = {k: F.regexp_replace(output, F.lit(pattern), F.lit(put)) for k, (_, pattern, put) in orders(markers).items()}
    return F.when(form == "psm", back["psm"]).when(form == "spm", back["spm"]).otherwise(output)


def _possessive(unit: str) -> str:
    """Runs of a unit are matched without ways back: a cut never falls inside one."""
    return re.sub(r"(?<=\])\+(?!\+)", "++", unit)

