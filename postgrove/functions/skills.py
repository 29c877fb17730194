"""Skills: vocabularies, tokenisers, extraction."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from postgrove.contract import NOT_SPECIFIED
from postgrove.functions.rules import word
from postgrove.functions.text import split_list

#: Category -> skill -> the names it goes by, in order.
CATALOG = {
    "programming_languages": {
        "Python": ["python"], "SQL": ["sql", "sql server", "t-sql", "pl/sql"], "R": ["r programming", "r language"], "Java": ["java"], "JavaScript": ["javascript", "js"],
        "TypeScript": ["typescript", "ts"], "Node.js": ["node.js", "nodejs", "node js"], "PHP": ["php"], "C#": ["c#", "c sharp", "csharp"], "C++": ["c++", "cpp"], ".NET": [".net", "dotnet"],
    },
    "frameworks_and_apis": {
        "React": ["react", "react.js", "reactjs"], "Angular": ["angular", "angular.js", "angularjs"], "Vue.js": ["vue", "vue.js", "vuejs"], "Django": ["django"], "Flask": ["flask"],
        "FastAPI": ["fastapi", "fast api"], "Spring": ["spring", "spring boot"], "REST APIs": ["rest api", "rest apis", "restful api", "api development"], "GraphQL": ["graphql"],
        "Microservices": ["microservices", "micro-services"],
    },
    "data_and_ai": {
        "Pandas": ["pandas"], "NumPy": ["numpy"], "Spark": ["spark", "apache spark"], "PySpark": ["pyspark"], "Airflow": ["airflow", "apache airflow"], "ETL": ["etl", "extract transform load"],
        "ELT": ["elt", "extract load transform"], "Data Warehousing": ["data warehouse", "data warehousing"], "Data Modeling": ["data modeling", "data modelling"],
        "Machine Learning": ["machine learning", "ml"], "Deep Learning": ["deep learning"], "Natural Language Processing": ["natural language processing", "nlp"],
        "Generative AI": ["generative ai", "genai"], "LLMs": ["llm", "llms", "large language model", "large language models"], "Computer Vision": ["computer vision"],
    },
    "databases": {
        "PostgreSQL": ["postgresql", "postgres"], "MySQL": ["mysql"], "Microsoft SQL Server": ["sql server", "mssql"], "Oracle Database": ["oracle database", "oracle db"],
        "MongoDB": ["mongodb", "mongo db"], "Redis": ["redis"], "Elasticsearch": ["elasticsearch", "elastic search"],
    },
    "cloud_and_devops": {
        "AWS": ["aws", "amazon web services"], "Azure": ["azure", "microsoft azure"], "GCP": ["gcp", "google cloud", "google cloud platform"],
        "Docker": ["docker", "containerization", "containerisation"], "Kubernetes": ["kubernetes", "k8s"], "Terraform": ["terraform"],
        "CI/CD": ["ci/cd", "continuous integration", "continuous delivery", "continuous deployment"], "Git": ["git", "github", "gitlab", "bitbucket"], "Linux": ["linux"],
    },
    "business_and_analytics": {
        "Power BI": ["power bi", "powerbi"], "Tableau": ["tableau"], "Excel": ["excel", "microsoft excel"], "Statistics": ["statistics", "statistical analysis"],
        "A/B Testing": ["a/b testing", "ab testing", "split testing"], "Forecasting": ["forecasting", "forecast models"], "Business Analysis": ["business analysis", "business analyst"],
    },
    "professional_skills": {
        "Communication": ["communication skills", "written communication", "verbal communication"], "Leadership": ["leadership", "team leadership", "people management"],
        "Problem Solving": ["problem solving", "problem-solving", "troubleshooting"], "Project Management": ["project management", "project manager"], "Agile": ["agile", "scrum", "kanban"],
    },
}
#: Names not counted as skills.
IGNORED = ["not specified", "none", "n/a", "na", "null", "undefined", "others", "other", "general", "skills"]
#: One spelling for common names.
CANONICAL = {
    "python": "Python", "py": "Python", "sql": "SQL", "mysql": "MySQL", "postgresql": "PostgreSQL", "postgres": "PostgreSQL", "aws": "AWS", "cloud": "Cloud", "azure": "Azure", "gcp": "GCP",
    "git": "Git", "github": "GitHub", "docker": "Docker", "kubernetes": "Kubernetes", "k8s": "Kubernetes", "react": "React", "react.js": "React", "reactjs": "React",
    "javascript": "JavaScript", "js": "JavaScript", "typescript": "TypeScript", "ts": "TypeScript", "node": "Node.js", "nodejs": "Node.js", "node.js": "Node.js", "java": "Java",
    "django": "Django", "flask": "Flask", "fastapi": "FastAPI", "html": "HTML", "css": "CSS", "tailwind": "Tailwind CSS", "linux": "Linux", "c": "C", "c++": "C++", "cpp": "C++", "c#": "C#",
    "ai": "AI / ML", "ml": "AI / ML", "machine learning": "Machine Learning", "data analysis": "Data Analysis", "data science": "Data Science", "spark": "Spark", "kafka": "Kafka",
    "redis": "Redis", "mongodb": "MongoDB", "nosql": "NoSQL", "powerbi": "Power BI", "power bi": "Power BI", "tableau": "Tableau", "pandas": "Pandas", "devops": "DevOps", "ci/cd": "CI/CD",
}
#: The technical skills reports count.
REPORTED = [
    "Python", "SQL", "Power BI", "Tableau", "Excel", "Java", "AWS", "Azure", "Git", "Docker", "Linux", "R", "Pandas", "NumPy", "Scikit-Learn", "JavaScript", "TypeScript", "React", "Node.js",
    "FastAPI", "C++", "C#", ".NET", "PostgreSQL", "MySQL", "MongoDB", "ETL", "Data Warehousing", "Machine Learning", "Testing", "Selenium", "API", "REST", "Kubernetes", "Spark", "DevOps",
]


def _names(low: Column, names: list[str]) -> Column:
    """Whether one of the names stands as a word; the pattern runs only where the letters occur at all."""
    out = F.lit(False)
    for n in names:
        out = out | (low.contains(n) & low.rlike(word(n)))
    return out


def catalog_skills(text: Column) -> Column:
    """array<struct(category, skill, evidence)> in catalogue order; the first name found is the evidence."""
    low = F.lower(text)
    found = []
    for category, skills in CATALOG.items():
        for skill, names in skills.items():
            evidence = F.coalesce(*[F.when(low.contains(n) & low.rlike(word(n)), F.lit(n)) for n in names])
            found.append(F.when(_names(low, names), F.struct(F.lit(category).alias("category"), F.lit(skill).alias("skill"), evidence.alias("evidence"))))
    return F.array_compact(F.array(*found))


def extract_skills(text: Column) -> Column:
    """The catalogue skills named in a text, joined by commas; the placeholder where none is."""
    found = lambda low: F.array_compact(F.array(*[F.when(_names(low, a), skill) for skills in CATALOG.values() for skill, a in skills.items()]))
    names = F.array_join(F.transform(F.array(F.lower(text)), found)[0], ", ")
    return F.when(F.length(F.coalesce(names, F.lit(""))) > 0, names).otherwise(NOT_SPECIFIED)


def labelled_skills(text: Column) -> Column:
    """What follows a "skills:" label up to the line's end or the next sentence; null without one."""
    return F.nullif(F.trim(F.regexp_extract(text, r"(?is)\b(?:key\s+|required\s+|technical\s+)?skills?\s*:\s*(.+?)(?:\n|\.\s+(?-i:[A-Z])|$)", 1)), F.lit(""))


def skill_items(c: Column, separators: str = r"[,|;]") -> Column:
    """The items of a skill text; the three tokenisers differ in their separators."""
    return split_list(c, separators)


def canonical_skill(item: Column) -> Column:
    """One spelling for common names, else the first letter raised."""
    table = F.create_map(*[F.lit(x) for kv in CANONICAL.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(item)), F.concat(F.upper(F.substring(item, 1, 1)), F.substr(item, F.lit(2))))


def countable(item: Column) -> Column:
    return (F.length(item) >= 2) & ~F.lower(item).isin(IGNORED)


def names_skill(text: Column, skill: str) -> Column:
    """The skill between word ends of both kinds, as a strict word filter tests it."""
    return text.rlike(rf"(?i)\b{re.escape(skill)}\b")


def reported_skills(skills: Column, description: Column) -> Column:
    """Which of the reported skills a posting names, each once."""
    blob = F.lower(F.concat_ws(" ", skills, description))
    return F.transform(F.array(blob), lambda low: F.array_compact(F.array(*[F.when(_names(low, [s.lower()]), s) for s in REPORTED])))[0]
