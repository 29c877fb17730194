"""Job categories, slots and labels."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from postgrove.functions.rules import count_contained, first_match

#: Categories by title, in order.
TITLE_RULES = [
    ("QA", r"(?i)\b(qa\b|tester|test\s+engineer|sdet|quality\s+assurance|automation\s+tester)"),
    ("Cloud", r"(?i)\b(cloud|devops|sre\b|site\s+reliability|infrastructure|sysadmin)"),
    ("DE", r"(?i)\b(data\s+engineer|etl\s+developer|pipeline\s+engineer|big\s+data|spark\s+developer)"),
    ("AI", r"(?i)\b(data\s+scientist|ai\s+engineer|machine\s+learning|\bml\b|artificial\s+intelligence|genai|deep\s+learning|nlp|computer\s+vision|llm)"),
    ("DA", r"(?i)\b(data\s+analyst|business\s+analyst|bi\s+developer|power\s+bi|tableau|reporting\s+analyst|statistician|\bbi\s+analyst|\bbi\s+developer|mis\s+executive)"),
    ("SE", r"(?i)\b(software|developer|frontend|backend|fullstack|full\s+stack|programmer|web\s+developer|react|java\s+dev|python\s+dev|node|angular|api\s+developer)"),
]
#: Categories by skills and description, in order.
BODY_RULES = [
    ("QA", r"(?i)\b(qa\b|tester|test\s+engineer|sdet|quality\s+assurance)"),
    ("DA", r"(?i)\b(data\s+analyst|business\s+analyst|power\s+bi|tableau|bi\s+developer)"),
    ("AI", r"(?i)\b(data\s+scientist|ai\s+engineer|machine\s+learning|\bml\b|genai|deep\s+learning)"),
    ("DE", r"(?i)\b(data\s+engineer|etl|pipeline|big\s+data)"),
    ("Cloud", r"(?i)\b(cloud|devops|aws|azure|docker|kubernetes)"),
    ("SE", r"(?i)\b(software|developer|frontend|backend|fullstack|react|node|java\b)"),
]


def job_category(title: Column, skills: Column, description: Column) -> Column:
    """The title decides first, then skills and description; else ``Other``."""
    return F.coalesce(first_match(F.lower(F.coalesce(title, F.lit(""))), TITLE_RULES), first_match(F.lower(F.concat_ws(" ", skills, description)), BODY_RULES), F.lit("Other"))


def signal_count(text: Column, words: list[str]) -> Column:
    """Overlapping substring signals, as the specialisation rules count them."""
    return count_contained(F.lower(F.coalesce(text, F.lit(""))), words)


#: The four domains, their slots and the terms that show them, in order.
DOMAINS = [
    (0, "Data & Analytics", ["data analyst", "data scientist", "data engineer", "business analyst", "power bi", "analytics"]),
    (1, "Python Development", ["python developer", "python backend", "django", "fastapi", "flask", "python"]),
    (2, "Java Development", ["java developer", "full stack java", "spring boot", "core java", "java"]),
    (3, "Cloud & DevOps", ["cloud engineer", "aws devops", "azure engineer", "kubernetes", "devops", "cloud", "aws", "gcp"]),
]
#: The search keywords of each slot.
SLOT_KEYWORDS = [
    (0, ["data analyst", "data scientist", "data engineer", "business analyst", "power bi"]),
    (1, ["python developer", "python backend", "django developer", "fastapi developer"]),
    (2, ["java developer", "full stack java", "spring boot developer", "core java"]),
    (3, ["cloud engineer", "aws devops", "azure engineer", "kubernetes developer"]),
]
#: Words of a keyword that tell no slot.
COMMON_WORDS = ["developer", "engineer", "analyst", "lead", "senior", "jr", "sr", "backend", "full", "stack"]
_PIECES = r"[\s,\-/]+"


def _first_true(cases: list[tuple[int, Column]]) -> Column:
    return F.coalesce(*[F.when(hit, slot) for slot, hit in cases])


def slot_of(keywords: Column) -> Column:
    """The first slot with a phrase that contains the keyword or is contained in it; else the first that shares a telling word; else null."""
    k = F.lower(F.trim(keywords))
    told = F.filter(F.split(k, _PIECES), lambda w: (w != "") & ~w.isin(COMMON_WORDS))
    phrase = [(slot, F.lit(False) if not words else reduce(or_, [k.contains(w) | F.lit(w).contains(k) for w in words])) for slot, words in SLOT_KEYWORDS]
    word = [(slot, F.arrays_overlap(told, F.lit(sorted({x for w in words for x in w.split()})))) for slot, words in SLOT_KEYWORDS]
    return F.when(k != "", F.coalesce(_first_true(phrase), _first_true(word))).cast("int")


def domain_slot(keywords: Column) -> Column:
    """The slot of the first domain one of whose terms the text contains; else null."""
    k = F.lower(keywords)
    return _first_true([(slot, reduce(or_, [k.contains(w) for w in words])) for slot, _, words in DOMAINS]).cast("int")


def domain_of(keywords: Column) -> Column:
    """The domain's name: general without keywords, custom where no term is found."""
    slot = domain_slot(keywords)
    named = F.coalesce(*[F.when(slot == i, name) for i, name, _ in DOMAINS], F.lit("Custom Extraction"))
    return F.when(F.length(F.coalesce(keywords, F.lit(""))) == 0, "General Extraction").otherwise(named)
