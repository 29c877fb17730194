"""Degrees named in free text: the lines that tell of them, the labels they name, the text without them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: The labels and the patterns that name each, in order.
DEGREES = [
    ("B.E/B.Tech", r"\bB\.\s*E\.?\b|\bB\.?\s*Tech\.?\b|\bBE\s*\([^)]*\)|\bBTech\s*\([^)]*\)|\bBE\s*/\s*B\.?Tech\b|\bBachelor\s+of\s+Engineering\b|\bBachelor\s+of\s+Technology\b|\bEngineering\s+bachelor'?s(?:\s+degree)?\b"),
    ("B.Sc", r"\bB\.?\s*Sc\.?\b|\bBachelor\s+of\s+Science\b|\bBS\b"), ("BCA", r"\bBCA\b|\bBachelor\s+of\s+Computer\s+Applications\b"), ("B.Com", r"\bB\.?\s*Com\.?\b|\bBachelor\s+of\s+Commerce\b"),
    ("BBA", r"\bBBA\b|\bBachelor\s+of\s+Business\s+Administration\b"), ("M.E/M.Tech", r"\bM\.\s*E\.?\b|\bM\.?\s*Tech\.?\b|\bMaster\s+of\s+Engineering\b|\bMaster\s+of\s+Technology\b"),
    ("M.Sc", r"\bM\.?\s*Sc\.?\b|\bMaster\s+of\s+Science\b|\bMS\b"), ("MCA", r"\bMCA\b|\bMaster\s+of\s+Computer\s+Applications\b"), ("MBA", r"\bMBA\b|\bMaster\s+of\s+Business\s+Administration\b"),
    ("PhD", r"\bPh\.?\s*D\.?\b|\bPhD\b|\bDoctorate\b"), ("Diploma", r"\bDiploma\b|\bEngineering\s+Diploma\b"),
    ("Any Bachelor's Degree", r"\b(?:any\s+graduate|any\s+graduation)\b|\b(?:graduated|graduate|graduation)\s+in\b|\bBachelor'?s\s+or\s+Master'?s\s+degree\b|\bBachelor'?s\s+or\s+associate\s+degree\b|\bBachelor(?:'s)?\s+degree\b|\bBachelor'?s\s+qualification\b|\bEngineering\s+degree\b|\bTechnical\s+degree\b"),
    ("Any Master's Degree", r"\bMaster(?:'s)?\s+degree\b|\bMaster'?s\s+qualification\b"),
]
GENERIC = ["Any Bachelor's Degree", "Any Master's Degree"]
EITHER = "Any Bachelor's Degree / Any Master's Degree"
#: What opens a degree section, what ends it, and what shows a degree within a line.
HEADER = r"(?i)^(?:educational\s+)?(?:qualification|education|eligibility|academics|degree|ug|pg)\s*[:\-]"
NEXT_SECTION = r"(?i)^(?:experience|skills|responsibilities|role|about|location|salary|benefits)\s*[:\-]"
NAMED = (
    r"(?i)\b(?:degree\b(?!-)|qualification|education|bachelor|master|phd|doctorate|b\.?tech|b\.?e\b|mca|bca|m\.?tech|b\.?sc|m\.?sc|mba|diploma|undergraduate|postgraduate|academic|major|field of study|graduate)\b"
)
COMPOUND = r"(?i)\b(?:bachelor'?s|b\.?e\.?|b\.?tech)\s*(?:or|\/|and)\s*(?:master'?s|m\.?e\.?|m\.?tech)\b"
IN_SENTENCE = r"(?i)\b(?:degree|qualification|education|bachelor|master|phd|doctorate|undergraduate|postgraduate|academic|major|field of study)\b"
FOLLOWING = 3


def degree_text(c: Column) -> Column:
    """The lines that tell of a degree: a header with up to three lines after it, or a line that names one; else the whole text."""
    text = F.translate(c, "’‘", "''")
    lines = F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), F.trim), lambda x: x != "")
    # State: the lines kept so far and how many more the last header takes.
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("left"))

    def step(state: Column, line: Column) -> Column:
        inside = (state["left"] > 0) & ~line.rlike(NEXT_SECTION)
        header = ~inside & line.rlike(HEADER)
        keep = inside | header | line.rlike(NAMED)
        return F.struct(
            F.when(keep, F.concat(state["kept"], F.array(line))).otherwise(state["kept"]).alias("kept"),
            F.when(header, F.lit(FOLLOWING)).when(inside, state["left"] - 1).otherwise(F.lit(0)).alias("left"),
        )

    kept = F.aggregate(lines, start, step, lambda s: s["kept"])
    told = F.transform(F.array(kept), lambda k: F.when(F.size(k) > 0, F.array_join(k, " \n ")))[0]
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", "").otherwise(F.coalesce(told, text))


def explicit_degrees(c: Column) -> Column:
    """array<string> of the degrees a text names: specific ones before the generic ones, the plainest ones anywhere if there is no other."""

    def named(t: Column) -> Column:
        found = F.array_compact(F.array(*[F.when(t.rlike(f"(?i){p}"), label) for label, p in DEGREES]))
        return F.transform(F.array(found), lambda f: F.when(F.size(F.array_except(f, F.lit(GENERIC))) > 0, F.array_except(f, F.lit(GENERIC))).otherwise(F.slice(f, 1, 1)))[0]

    plain = F.array_compact(F.array(*[F.when(c.rlike(f"(?i){p}"), label) for label, p in DEGREES if label in ("B.E/B.Tech", "M.E/M.Tech", "MCA", "BCA")]))
    told = F.transform(F.array(degree_text(c)), lambda t: F.when(t.rlike(COMPOUND), F.array(F.lit(EITHER))).otherwise(named(t)))[0]
    chosen = F.transform(F.array(told), lambda f: F.when(F.size(f) > 0, f).otherwise(plain))[0]
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(chosen)


def text_without_degrees(c: Column) -> Column:
    """The sentences that tell of no degree, joined by blanks."""
    return F.array_join(F.filter(F.transform(F.split(c, r"\r?\n+|(?<=[.!?])\s+"), F.trim), lambda s: (s != "") & ~s.rlike(IN_SENTENCE)), " ")
