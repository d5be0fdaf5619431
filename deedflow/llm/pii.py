"""Personal data by weak supervision, in DataFrame functions only.

Base spans (email, ip, card, phone) come from fixed patterns and checks.  Further candidates
(``ADDED``) are voted on by three labelers each: a stricter pattern, a gazetteer and the words
before the span; a vote is 1, -1 or 0 (none).  Expectation maximisation over the counts of vote
patterns estimates how reliable each labeler is and how likely each pattern is a true span; a logistic
classifier over votes and span features is then fitted to these chances and applied as a column
expression.  Counts are taken over all texts, and their number is bounded by the number of patterns.

Places are found from the lengths of the pieces between matches.  The patterns are written so that a
search is linear in the text: runs are possessive, and a run that failed at its start is not tried
from its middle (``\\G`` allows the start right after a match).

Defined results: a null text is an empty one; a null id is carried; repeated rows are judged alike;
places are code points, ends exclusive.  The list of one text's spans is copied when a span is added,
16 bytes each.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EMAIL_CHARS = "[A-Za-z0-9._%+-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Kind: what must be in the text, pattern, test of a match ``x``.
BASE = {
    "email": ("@", rf"(?:(?<!{_EMAIL_CHARS})|\G){_EMAIL_CHARS}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true"),
    "ip": (
        ".",
        r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        rf"x rlike r'^{_OCTET}(?:\.{_OCTET}){{3}}$'",
    ),
    "card": (
        None,
        r"[0-9](?:[\x20-]?[0-9])++",
        "length(x) >= 13 AND length(regexp_replace(x, '[^0-9]', '')) BETWEEN 13 AND 19 "
        "AND luhn_check(regexp_replace(x, '[^0-9]', ''))",
    ),
    "phone": (
        "+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "length(regexp_replace(x, '[^0-9]', '')) BETWEEN 9 AND 15",
    ),
}

# Frequent given names, and cue words by kind.
GIVEN_NAMES = (
    "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard "
    "Susan Joseph Jessica Thomas Sarah Charles Karen Anna Maria Peter Paul Hans Klaus Pierre Jean Marie "
    "Carlos Jose Juan Luis Carmen Ana Sofia Laura Julia Emma Lukas Jan Eva Marta Pablo Claire Louis"
)
SECRET_CUES = "token|secret|passw|key|auth|credential|bearer|api"
PHONE_CUES = "call|phone|tel|mobile|cell|fax|contact|whatsapp"
NAME_CUES = r"\b(?:mr|mrs|ms|dr|prof|name|named|sincerely|regards|contact|herr|frau|se[nñ]or|mme)"

_NAMES = "|".join(GIVEN_NAMES.split())
#: Kind: pattern, then the labelers' yes and no on the match ``x`` and the words ``before`` it.
ADDED = {
    "secret": (
        r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])(?=[0-9_]*+[A-Za-z])[A-Za-z0-9_]{16,}+",
        (r"x rlike r'^(?:[0-9a-f]{24,}|[0-9A-F]{24,}|(?:sk|pk|ghp|AKIA)[A-Za-z0-9_]+)$'", "length(x) < 20"),
        (r"x rlike r'^(?:sk_|pk_|ghp_|xox|AKIA)'", r"x rlike r'^(?:[A-Za-z]+_)+[A-Za-z]+[0-9]?$'"),
        (rf"before rlike r'(?i)(?:{SECRET_CUES})[^\n]{{0,8}}$'", r"before rlike r'[/]$'"),
    ),
    "local_phone": (
        r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])",
        (r"x rlike r'^(?:\([0-9]{3}\) |[0-9]{3}([.-]))[0-9]{3}(?:\1|-)[0-9]{4}$'", r"x rlike r'^0{3}'"),
        (r"x rlike r'[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}'", r"x rlike r'^\(?[01]'"),
        (rf"before rlike r'(?i)(?:{PHONE_CUES})[^0-9\n]{{0,12}}$'", r"before rlike r'(?i)(?:isbn|no|id|order)[ .:#]*$'"),
    ),
    "name": (
        r"(?<![A-Za-z])[A-Z][a-z]{1,20}\x20[A-Z][a-z]{1,20}(?![A-Za-z])",
        (r"x rlike r'^[A-Z][a-z]+ [A-Z][a-z]{2,}$'", "length(x) < 6"),
        (rf"x rlike r'^(?:{_NAMES}) '", rf"NOT (x rlike r'\b(?:{_NAMES})\b')"),
        (rf"before rlike r'(?i){NAME_CUES}[.:,]? ?$'", r"before rlike r'[.!?]\s*$' OR before = ''"),
    ),
}
VOTES = ("pattern", "gazetteer", "context")
FEATURES = ("long", "digits", "quoted")
_CONTEXT = 24
ROUNDS, STEPS = 300, 400


def _pieces(kind: str, pattern: str, needed: str | None) -> tuple[Column, Column]:
    """Matches of a pattern, and the pieces before, between and after them."""
    text = F.col("_text")
    found, rest = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    if needed:
        found = F.when(text.contains(needed), found).otherwise(F.array().cast("array<string>"))
        rest = F.when(text.contains(needed), rest).otherwise(F.array(text))
    return found.alias(f"_m_{kind}"), rest.alias(f"_p_{kind}")


def _placed(kind: str, test: str, fields: str = "", names: str = "") -> str:
    """The spans of a kind that pass ``test``, in order; ``fields`` may use x, before and after."""
    m, p = f"_m_{kind}", f"_p_{kind}"
    start = f"acc.at + length({p}[i])"
    entry = f"named_struct('s', {start}, 'e', {start} + length({m}[i]){names})"
    for name, value in (("before", f"right({p}[i], {_CONTEXT})"), ("after", f"left({p}[i + 1], 1)"), ("x", f"{m}[i]")):
        entry, test = _bound(entry, name, value), _bound(test, name, value)
    empty = f"CAST(array() AS array<struct<s:int,e:int{fields}>>)"
    step = (
        f"named_struct('at', {start} + length({m}[i]), "
        f"'out', CASE WHEN {test} THEN array_append(acc.out, {entry}) ELSE acc.out END)"
    )
    fold = (
        f"aggregate(sequence(0, size({m}) - 1), named_struct('at', 0, 'out', {empty}), "
        f"(acc, i) -> {step}, acc -> acc.out)"
    )
    return f"CASE WHEN size({m}) = 0 THEN {empty} ELSE {fold} END"


def _bound(expression: str, name: str, value: str) -> str:
    """``expression`` with the bare word ``name`` replaced; string literals in it are left alone."""
    out = []
    for i, part in enumerate(expression.split("'")):
        out.append(part if i % 2 else " ".join(value if w == name else w for w in _words(part)))
    return "'".join(out)


def _words(part: str) -> list[str]:
    for mark in "(),":
        part = part.replace(mark, f" {mark} ")
    return part.split(" ")


def _votes(kind: str) -> str:
    votes = [f"CASE WHEN {yes} THEN 1 WHEN {no} THEN -1 ELSE 0 END" for yes, no in ADDED[kind][1:]]
    features = [
        "CASE WHEN length(x) < 14 THEN 0 WHEN length(x) < 30 THEN 1 ELSE 2 END",
        "least(3, CAST(4 * length(regexp_replace(x, '[^0-9]', '')) / length(x) AS int))",
        "CASE WHEN right(before, 1) IN ('\"', '`') AND after IN ('\"', '`') THEN 1 ELSE 0 END",
    ]
    return "".join(f", '{n}', {v}" for n, v in zip((*VOTES, *FEATURES), (*votes, *features), strict=True))


def with_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base spans by kind and the candidates with votes and features."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    found = [c for kind, (needed, pattern, _) in BASE.items() for c in _pieces(kind, pattern, needed)]
    found += [c for kind, (pattern, *_) in ADDED.items() for c in _pieces(kind, pattern, None)]
    rows = rows.select("doc_id", *found)
    base = [F.expr(_placed(kind, test)).alias(kind) for kind, (_, _, test) in BASE.items()]
    fields = "".join(f",{n}:int" for n in (*VOTES, *FEATURES))
    added = [F.expr(_placed(kind, "true", fields, _votes(kind))).alias(kind) for kind in ADDED]
    rows = rows.select("doc_id", *base, *added)
    taken = F.flatten(F.array(*BASE))
    apart = {
        kind: F.filter(kind, lambda c: ~F.exists("_base", lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
        for kind in ADDED
    }
    return rows.withColumn("_base", taken).withColumns(apart).drop("_base")


@dataclass
class Model:
    """Reliabilities by kind and labeler, and the classifier's weights by kind, name and value."""

    reliability: dict[str, np.ndarray]
    weights: dict[str, dict[tuple[str, int], float]]

    def score(self, kind: str, span: Column) -> Column:
        total = F.lit(float(self.weights[kind]["bias", 0]))
        for (name, value), weight in self.weights[kind].items():
            if name != "bias":
                total = total + F.when(span[name] == value, float(weight)).otherwise(0.0)
        return total


def estimate(counts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Expectation maximisation over (votes, count) patterns of one kind.

    Returns the chance of each vote (-1, 0, 1) by class and labeler, and each pattern's chance to be true.
    """
    votes = np.array([v for v, _ in counts]) + 1
    n = np.array([c for _, c in counts], float)
    table = np.tile(np.array([[0.55, 0.35, 0.10], [0.10, 0.30, 0.60]])[:, None, :], (1, votes.shape[1], 1))
    share = 0.5
    for _ in range(ROUNDS):
        chance = np.log([1 - share, share])[:, None] + sum(
            np.log(table[:, j, :][:, votes[:, j]]) for j in range(votes.shape[1])
        )
        true = 1 / (1 + np.exp(np.clip(chance[0] - chance[1], -50, 50)))
        share = float(np.clip((n @ true + 1) / (n.sum() + 2), 0.01, 0.99))
        for k, belief in enumerate((1 - true, true)):
            for j in range(votes.shape[1]):
                # Smoothed towards the start, so that a labeler that is never heard keeps its meaning.
                seen = np.bincount(votes[:, j], n * belief, 3)
                first = np.array([[0.55, 0.35, 0.10], [0.10, 0.30, 0.60]][k]) * 10
                table[k, j] = (seen + first) / (seen + first).sum()
    return table, true


def fit(patterns: list[tuple[str, tuple, tuple, int]]) -> Model:
    """The model from counts of (kind, votes, features)."""
    model = Model({}, {})
    for kind in ADDED:
        rows = [(v, f, n) for k, v, f, n in patterns if k == kind]
        model.weights[kind] = {("bias", 0): -1.0}
        if not rows:
            continue
        by_votes: dict[tuple, int] = defaultdict(int)
        for v, _, n in rows:
            by_votes[v] += n
        ordered = sorted(by_votes.items())
        model.reliability[kind], true = estimate(ordered)
        belief = dict(zip((v for v, _ in ordered), true, strict=True))
        names = sorted({(name, x) for v, f, _ in rows for name, x in zip((*VOTES, *FEATURES), (*v, *f), strict=True)})
        at = {key: i for i, key in enumerate(names)}
        x = np.zeros((len(rows), len(names) + 1))
        for i, (v, f, _) in enumerate(rows):
            for key in zip((*VOTES, *FEATURES), (*v, *f), strict=True):
                x[i, at[key]] = 1
        x[:, -1] = 1
        y, n = np.array([belief[v] for v, _, _ in rows]), np.array([c for *_, c in rows], float)
        n /= n.sum()
        w = np.zeros(len(names) + 1)
        for _ in range(STEPS):
            w -= 2.0 * (x.T @ (n * (1 / (1 + np.exp(-x @ w)) - y)) + 1e-4 * w)
        model.weights[kind] = {**{k: float(w[i]) for k, i in at.items()}, ("bias", 0): float(w[-1])}
    return model


def learn(docs: DataFrame) -> Model:
    """Count vote patterns over all texts, estimate the labelers and fit the classifier."""
    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    rows = rows.select(*[c for kind, (pattern, *_) in ADDED.items() for c in _pieces(kind, pattern, None)])
    fields = "".join(f",{n}:int" for n in (*VOTES, *FEATURES))

    def named(kind: str) -> Column:
        return F.transform(F.expr(_placed(kind, "true", fields, _votes(kind))), lambda c: c.withField("kind", F.lit(kind)))

    kinds = [named(kind) for kind in ADDED]
    names = ["kind", *VOTES, *FEATURES]
    counts = (
        rows.select(F.explode(F.concat(*kinds)).alias("c"))
        .groupBy(*[F.col(f"c.{n}").alias(n) for n in names])
        .count()
        .collect()
    )
    return fit(sorted((r.kind, tuple(r[v] for v in VOTES), tuple(r[f] for f in FEATURES), r["count"]) for r in counts))


def find_personal_data(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and an array of spans (s, e) per kind, base kinds and those that the classifier accepts."""

    def accepted(kind: str) -> Column:
        return F.filter(kind, lambda span: model.score(kind, span) >= 0)

    return with_spans(docs).withColumns({kind: accepted(kind) for kind in ADDED})


def span_list(*kinds: str) -> Column:
    """kind:start:end of the spans, by kind as given, then start, joined by commas."""


    def texts(kind: str) -> Column:
        return F.transform(kind, lambda c: F.concat_ws(":", F.lit(kind), c["s"].cast("string"), c["e"].cast("string")))

    return F.array_join(F.concat(*[texts(kind) for kind in kinds]), ",")
