"""Whether a title is relevant to a search query: an ordered decision list in one expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from postgrove.functions.rules import word

#: Roles unrelated to technical searches.
UNRELATED = {
    "sales": ["sales", "business development", "bde", "bdm", "account executive", "telecaller", "telesales", "inside sales", "lead generation"],
    "hr": ["hr", "human resources", "recruiter", "recruitment", "talent acquisition", "sourcing specialist", "headhunter", "hrbp"],
    "marketing": ["seo", "content writer", "copywriter", "digital marketing", "social media", "growth marketing", "graphic designer", "brand manager"],
    "operations_finance": ["accountant", "accounting", "auditor", "chartered accountant", "billing", "tax consultant", "financial analyst", "bookkeeper", "office assistant", "receptionist", "store manager"],
    "healthcare": ["nurse", "doctor", "pharmacist", "clinical", "hospital", "physician"],
}
#: Technologies and their names, in order.
TECH = {
    "python": ["python", "django", "fastapi", "flask", "pyspark"],
    "java": ["java", "spring", "springboot", "j2ee", "hibernate"],
    "javascript": ["javascript", "react", "reactjs", "node", "nodejs", "typescript", "angular", "vue", "frontend", "front-end"],
    "c#": ["c#", "csharp", ".net", "dotnet", "asp.net"], "c++": ["c++", "cpp"], "php": ["php", "laravel", "codeigniter", "wordpress"], "ruby": ["ruby", "rails"],
    "golang": ["golang", "go developer", "go engineer"], "devops": ["devops", "sre", "site reliability", "kubernetes", "docker", "sysadmin", "infrastructure"],
    "qa": ["qa", "sdet", "test engineer", "automation tester", "manual tester", "quality assurance"],
}
_OTHER_LANGUAGES = ["java", "c#", ".net", "dotnet", "php", "ruby", "golang", "c++", "android", "ios", "swift", "kotlin"]
_PYTHON_ROLES = [
    "developer", "engineer", "programmer", "coder", "architect", "lead", "intern", "consultant", "specialist", "backend", "full stack", "fullstack", "sde", "swe", "automation", "tech lead",
    "fresher", "trainee", "associate", "junior", "entry",
]
_DEV_ROLES = [
    "developer", "software engineer", "backend", "full stack", "fullstack", "programmer", "associate software", "engineer", "coder", "architect", "sde", "swe", "intern", "trainee", "lead",
    "specialist", "consultant", "automation",
]


def plain(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[/\\|,;:\-_()\[\]{}]+", " "), r"\s+", " "))


def _any(text: Column, words: list[str]) -> Column:
    return text.rlike("|".join(word(w) for w in words))


def role_relevant(title: Column, query: Column) -> Column:
    """True or false for every pair; blank titles and queries are relevant."""
    t, q = plain(title), plain(query)
    unrelated = reduce(lambda a, b: a | b, [~_any(q, w) & _any(t, w) for w in UNRELATED.values()])
    analyst = (_any(q, ["data"]) & _any(q, ["analyst"])) | q.contains("data analyst") | q.contains("analytics")
    analyst_fits = _any(t, ["analyst", "analytics"]) & _any(t, ["data", "bi", "business intelligence", "reporting", "insights", "product", "sql"])
    conflicts = _any(t, ["scientist", "software engineer", "sales", "recruiter"])
    python_dev = _any(q, ["python"]) & _any(q, ["developer", "engineer", "programmer", "coder", "dev", "backend"])
    python_title = _any(t, TECH["python"])
    wrong = _any(t, ["data scientist", "data science", "data analyst", "business analyst"]) | (_any(t, ["data engineer"]) & ~_any(t, ["python"]))
    other = ~python_title & _any(t, _OTHER_LANGUAGES) & (t.contains("developer") | t.contains("engineer"))
    python_fits = F.when(wrong | other, False).when(python_title, _any(t, _PYTHON_ROLES)).otherwise(_any(t, _DEV_ROLES))
    tech_wrong = F.lit(False)
    for name, names in reversed(TECH.items()):
        rest = [w for k, v in TECH.items() if k != name for w in v]
        tech_wrong = F.when(_any(q, [name]), ~_any(t, names) & _any(t, rest)).otherwise(tech_wrong)
    tokens = F.filter(F.split(q, " "), lambda w: (F.length(w) > 2) & ~w.isin("and", "for", "the", "with"))
    padded = F.concat(F.lit(" "), t, F.lit(" "))
    share = F.size(F.filter(tokens, lambda w: padded.contains(F.concat(F.lit(" "), w, F.lit(" "))))) / F.size(tokens)
    return (
        F.when((t == "") | (q == ""), True).when(t.contains(q), True).when(unrelated, False).when(analyst, ~conflicts & analyst_fits)
        .when(python_dev, python_fits).when(tech_wrong, False).when(F.size(tokens) == 0, True).otherwise(share >= 0.5)
    )
