"""Page boilerplate mixed with main content: keep only the employer's text.

Maximum-scoring subsequence: every word and every tag of a line has a weight, positive for body text and negative for
the page around it.  A line scores the sum of its weights; a linear scan picks the set of line ranges of greatest total
score, where opening a range costs ``OPEN`` (``best_ranges``).  With ``ranges=1`` it is the single best contiguous
region; the pages here carry widgets amid the text, so several ranges are allowed.

The weights are log odds of a naive Bayes model over labelled lines.  Labels come from a table of labelled lines where
one is given; else ``structure_labels`` takes them from where lines stand and what they are tied to, without any list of
phrases, on a bounded sample of pages (``SAMPLE_PAGES``, drawn by a hash of the text, so equal pages are drawn together):
a line that names the posting's own employer or holds one of its own values is the employer's; so is a sentence amid
sentences and a short line between two sentences; what stands outside a page's sentences is the page's, and so are its
outermost sentences.  The last is wrong for the first and last sentence of the employer's text, but the words of such
sentences stand amid others in most pages, so their weights come out positive all the same.

"Tags" of a text page are what is left of its markup: menu separators, brackets, runs of blanks, arrows.

Defined cases: a missing text gives no line; an empty or blank line never counts as a line of the page and scores 0;
repeated rows each give their lines; a page of one line is judged by that line; very long lines are scored by their
mean over windows of ``LONG`` words so that no line outweighs the rest without bound; input columns other than the key,
the text and the owner are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from postgrove.contract import known

SAMPLE_PAGES = 5_000
OPEN = 1.0
LONG = 40
BOUND = 4.0

_SEPARATOR = re.compile(r"\s[>»|·/•]\s|\s{2,}|[\[\]<>»©→]")
_WORD = re.compile(r"[^\W\d_]+|[#\x01]")
_NUMBER = re.compile(r"\d[\d,.]*")
_SIZES = [f"<size {i}>" for i in range(11)]

_VALUES = re.compile(r"[,;|\n\t·•▪\"\[\]()]|\s/\s")
#: A sentence has at least so many words and a stop at its end.
SENTENCE = 6


def normal(line: str, owner: str = "") -> str:
    """The line with its owner's name and every number as one sign each."""
    line = line.replace("&amp;", "and").casefold()
    if owner:
        line = line.replace(owner, "\x01")
    return _NUMBER.sub("#", line)


def features(line: str, own: bool = False) -> list[str]:
    """The words, word pairs and tags of a normal line; ``own`` if it holds a value of its record."""
    words = _WORD.findall(line)
    out = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    text = line.strip()
    out += ["<tag>"] * min(len(_SEPARATOR.findall(text)), 6)
    if text[:2] in ("- ", "* ", "• "):
        out.append("<bullet>")
    stop = text[-1:]
    out.append("<stop>" if stop and stop in ".!?" else "<colon>" if stop == ":" else "<open>")
    out.append(_SIZES[min(len(words), 30) // 3])
    if own:
        out.append("<own>")
    return out


def holds_own(line: str, values: list[str]) -> bool:
    """A line that is no sentence and holds a value of its record."""
    return not is_sentence(line) and any(v in line for v in values)


def is_sentence(line: str) -> bool:
    text = line.strip()
    return text[-1:] in tuple(".!?") and len(text.split()) >= SENTENCE


def structure_labels(lines: list[str], values: list[str]) -> list[bool | None]:
    """True for a normal line of the page, False for the employer's, None where structure does not show it.

    ``values`` are values of the page's own record, normal as the lines are.
    """
    full = [is_sentence(x) for x in lines]
    at = [i for i, x in enumerate(full) if x]
    said = [i for i, x in enumerate(lines) if x.strip()]
    place = {i: k for k, i in enumerate(said)}
    out: list[bool | None] = [None] * len(lines)
    for i in said:
        if "\x01" in lines[i] or holds_own(lines[i], values):
            out[i] = False
            continue
        # The first and last sentence beside this line.
        first, last = (at[1:2] if at[:1] == [i] else at[:1]), (at[-2:-1] if at[-1:] == [i] else at[-1:])
        if not first or not last:
            continue
        outside = i < first[0] or i > last[0]
        k = place[i]
        if outside or full[i]:
            out[i] = outside or full[i] and (k == 0 or k == len(said) - 1)
        elif full[said[k - 1]] and full[said[k + 1]]:
            out[i] = False
    return out


def line_score(line: str, weights: dict[str, float], own: bool = False) -> float:
    """The score of a normal line; a blank one has 0."""
    found = features(line, own)
    if len(found) < 3:
        return 0.0
    get = weights.get
    total = sum([get(f, 0.0) for f in found])
    return total if len(found) <= 2 * LONG else total * 2 * LONG / len(found)


def best_ranges(scores: list[float], ranges: int | None = 1, opening: float = OPEN) -> list[bool]:
    """Which lines belong to the ranges of greatest total score.

    Without a limit each range costs ``opening``; with ``ranges=1`` it is the maximum-scoring subsequence.
    """
    n = len(scores)
    if ranges == 1:
        best = run = 0.0
        start = 0
        span = (0, 0)
        for i, s in enumerate(scores):
            if run <= 0:
                run, start = 0.0, i
            run += s
            if run > best:
                best, span = run, (start, i + 1)
        return [span[0] <= i < span[1] for i in range(n)]
    out_, in_ = 0.0, -math.inf
    back: list[tuple[bool, bool]] = []  # whether the best way out of / into this line's state came from inside
    for s in scores:
        enter = out_ - opening
        keep = in_ if in_ >= enter else enter
        back.append((in_ > out_, in_ >= enter))
        out_, in_ = max(out_, in_), keep + s
    # After the last line, outside is reached from either.
    inside = in_ > out_
    kept = [False] * n
    for i in range(n - 1, -1, -1):
        kept[i] = inside
        inside = back[i][1] if inside else back[i][0]
    return kept


def _values(text: str | None, owner: str) -> list[str]:
    return [normal(v.strip(), owner) for v in _VALUES.split(text or "") if len(v.strip()) > 1]


def learn(pages: DataFrame, labels: DataFrame | None = None, key: str | None = None) -> dict[str, float]:
    """Weights from a bounded sample of labelled pages; ``pages`` has ``__t``, ``__o`` and ``__v``.

    ``labels`` (key, line_no, is_page), if given, replaces the structure; only its pages are read.
    """
    cols = ["__t", "__o", "__v"]
    if labels is not None:
        marks = labels.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("line_no", "is_page"))).alias("__l"))
        pages = pages.join(marks, key).select(*cols, F.to_json("__l").alias("__l"))
    else:
        pages = pages.select(*cols, F.lit(None).cast("string").alias("__l"))
    n = pages.count()
    if n > SAMPLE_PAGES:
        share = int(SAMPLE_PAGES / n * 2**31)
        pages = pages.filter(F.pmod(F.xxhash64("__t"), F.lit(2**31)) < share)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        page, body = Counter(), Counter()
        lines = [0, 0]
        for batch in batches:
            for t, o, v, marks in zip(batch["__t"], batch["__o"], batch["__v"], batch["__l"]):
                o = (o or "").casefold()
                found, values = [normal(line, o) for line in t.split("\n")], _values(v, o)
                if isinstance(marks, str):
                    told = json.loads(marks)
                    labelled = [told.get(str(i)) for i in range(1, len(found) + 1)]
                else:
                    labelled = structure_labels(found, values)
                for line, label in zip(found, labelled):
                    if label is not None:
                        lines[label] += 1
                        (page if label else body).update(set(features(line, holds_own(line, values))))
        page[""], body[""] = lines[1], lines[0]
        names = list(page.keys() | body.keys())
        yield pd.DataFrame({"f": names, "p": [page[x] for x in names], "b": [body[x] for x in names]})

    # Bounded by the words of the sampled pages.
    rows = pages.mapInPandas(count, "f string, p bigint, b bigint").groupBy("f").agg(F.sum("p").alias("p"), F.sum("b").alias("b")).collect()
    total = next(((r.p, r.b) for r in rows if r.f == ""), (0, 0))
    p_all, b_all = total[0] + 1, total[1] + 1
    odds = lambda r: math.log((r.b + 0.5) / b_all) - math.log((r.p + 0.5) / p_all)
    # A feature seen once or twice says little: the smoothing alone keeps it near the base odds.
    return {r.f: max(-BOUND, min(BOUND, odds(r) * (r.p + r.b) / (r.p + r.b + 1))) for r in rows if r.f}


def page_lines(pages: DataFrame, key: str, text: str, owner: str | None = None, values: str | None = None, labels: DataFrame | None = None, ranges: int | None = 1) -> DataFrame:
    """(key, line_no) of every line that belongs to the page and not to the employer's text.

    ``owner`` and ``values`` are columns with the employer's name and with values of the record, which tie a line to its
    posting.  ``ranges=1`` keeps the single best contiguous region; None keeps as many as pay for their opening, for pages
    that carry widgets amid the text.
    """
    column = lambda c: F.col(c) if c else F.lit("")
    pages = pages.select(F.col(key), known(F.col(text)).alias("__t"), column(owner).alias("__o"), known(column(values)).alias("__v")).filter(F.col("__t").isNotNull())
    weights = learn(pages, labels, key)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[tuple[str, bool], float] = {}
        for batch in batches:
            keys, numbers = [], []
            for k, t, o, v in zip(batch[key], batch["__t"], batch["__o"], batch["__v"]):
                o = (o or "").casefold()
                lines, own = t.split("\n"), _values(v, o)
                scores = []
                for line in lines:
                    line = normal(line, o)
                    asked = line, bool(own) and holds_own(line, own)
                    score = cache.get(asked)
                    if score is None:
                        score = line_score(line, weights, asked[1])
                        if len(cache) < 100_000 and len(line) < 200:
                            cache[asked] = score
                    scores.append(score)
                for i, (line, kept) in enumerate(zip(lines, best_ranges(scores, ranges)), 1):
                    if not kept and line.strip():
                        keys.append(k)
                        numbers.append(i)
            yield pd.DataFrame({key: keys, "line_no": pd.Series(numbers, dtype="int32")})

    kind = dict(pages.dtypes)[key]
    return pages.mapInPandas(mark, f"`{key}` {kind}, line_no int")


def main_text(pages: DataFrame, key: str, text: str, owner: str | None = None, values: str | None = None, labels: DataFrame | None = None, ranges: int | None = 1) -> DataFrame:
    """(key, main_text): what remains, in order; null where nothing does."""
    gone = page_lines(pages, key, text, owner, values, labels, ranges).groupBy(key).agg(F.collect_set("line_no").alias("__no"))
    # A key that repeats gives its lines once for each row; equal keys hold equal texts or are told apart before.
    lines = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(F.coalesce(F.col("__no"), F.array().cast("array<int>")), i + 1))
    return pages.join(gone, key, "left").select(F.col(key), F.array_join(lines, "\n").alias("main_text"))
