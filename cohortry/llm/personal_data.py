"""Personal data by weak supervision, in DataFrame functions only.

Base spans (email, ip, card, phone) come from fixed patterns and checks and always stay. Further candidates (secret,
ssn, iban, local phone, titled name) come from wider patterns. On every candidate of the corpus five labelers vote
for, against or not at all: its format, a gazetteer, the words before it, its neighbours and a list of placeholders.
Votes are counted per pattern of votes (a table whose size the labelers bound), expectation-maximisation estimates
each labeler's reliability per kind from the counts alone, and the posteriors train a logistic span classifier on
votes and length. The classifier's weights become a Column, so no row leaves the JVM. A further candidate that
overlaps no base span and scores 0.5 or more is added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns. Possessive runs and look-behinds only spare the scan retries; they match the same spans.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
EXTRA = {
    "secret": r"(?<=(?:token|key|secret|password|TOKEN|KEY|SECRET|PASSWORD)[\"']?\x20{0,3}[:=]\x20{0,3}[\"']?)(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{12,}+",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9-])",
    "name": r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame)\.?\x20\p{Lu}\p{L}{1,20}(?:\x20\p{Lu}\p{L}{1,20})?",
}
#: A text without any of these holds no span of the kind.
NEEDED = {
    "email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]",
    "secret": "(?:token|key|secret|password|TOKEN|KEY|SECRET|PASSWORD)[\"']?\\x20{0,3}[:=]", "ssn": "[0-9]-[0-9]{2}-[0-9]",
    "iban": "[A-Z]{2}[0-9]{2}", "local_phone": "[0-9][-.\\x20)]\\x20?[0-9]{3}[-.\\x20][0-9]{4}",
    "name": "(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Monsieur|Madame)\\.?\\x20",
}
KINDS = [*BASE, *EXTRA]
LABELERS = ("format", "gazetteer", "before", "neighbours", "placeholder")
CONTEXT = 24
#: Matches that one fold goes through.
BLOCK = 256
ARRAY = "array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string>>"

FORMAT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{12,19}|(?:[0-9]{4}[\x20-]){3}[0-9]{1,7})$",
    "phone": r"^\+[0-9]{1,3}(?:[\x20.-]?\(?[0-9]{1,4}\)?){2,5}$",
    "secret": r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_-]{16,128}$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?$",
    "local_phone": r"^(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[-.\x20])[2-9][0-9]{2}[-.\x20][0-9]{4}$",
    "name": r"^\S+\x20\S+\x20\S+$",
}
GAZETTEER = {
    "email": r"\.(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|us|ca|ch|at|nl|pl)$",
    "ip": r"^(?:10|172|192|[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|3[0568]|6)",
    "phone": r"^\+(?:1|7|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2389][0-9]{2})",
    "secret": r"^(?:[0-9a-f]{32,}|[A-Za-z0-9+/_-]{40,}|sk|pk|gh|xox|AK)",
    "ssn": r"^[0-8]",
    "iban": r"^(?:AD|AT|BE|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IS|IT|LI|LT|LU|LV|MC|MT|NL|NO|PL|PT|RO|SE|SI|SK)",
    "local_phone": r"^\(?[2-9][0-8][0-9]",
    "name": r"\x20(?:Anna|Ana|Carlos|Claire|David|Elena|Hans|Jean|Jorge|John|José|Juan|Julia|Karl|Laura|Louis|Luis|Maria|Marie|Mary|"
    r"Michael|Paul|Peter|Pierre|Robert|Sarah|Sofia|Thomas|Smith|Müller|Schmidt|García|Martin|Dubois)\b",
}
BEFORE = {
    "email": r"mail|contact|write|kontakt|correo|courriel|@",
    "ip": r"\bip\b|host|server|address|login|from",
    "card": r"card|visa|credit|karte|tarjeta|carte|pay",
    "phone": r"tel|phone|call|mobile|fax|ruf|llama|appel",
    "secret": r"token|key|secret|password",
    "ssn": r"ssn|social|security",
    "iban": r"iban|account|konto|cuenta|compte|bank",
    "local_phone": r"tel|phone|call|mobile|fax",
    "name": r"dear|by|with|from|von|de|und|and",
}
PLACEHOLDER = r"(?i)^(?:0+[.-]?)+$|127\.0\.0\.1|(.)\1{7,}|123456789|^x+$|placeholder|changeme|your[_-]"


def _spans(text: Column, kind: str) -> Column:
    """Array of (start, rank, end, kind, value) of the kind's matches that hold: positions add up from what lies between matches.

    Matches are taken in blocks: a fold appends to arrays no longer than a block, so the work grows with the matches and
    not with their square."""
    pattern = F.lit({**BASE, **EXTRA}[kind])
    rank = KINDS.index(kind)
    cells = F.zip_with(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        F.split(text, {**BASE, **EXTRA}[kind], -1),
        lambda m, gap: F.struct(m.alias("value"), F.length(gap).cast("long").alias("gap")),
    )
    none = F.array().cast(ARRAY)

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["value"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
        # The last piece has no match behind it.
        held = x["value"].isNotNull() & _holds(kind, x["value"])
        return F.struct(F.coalesce(end, start).alias("at"), F.when(held, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    def block(acc, part):
        begun = F.struct(acc["at"].alias("at"), none.alias("spans"))
        done = F.aggregate(part, begun, step)
        return F.struct(done["at"].alias("at"), F.concat(acc["blocks"], F.array(done["spans"])).alias("blocks"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{ARRAY}>").alias("blocks"))

    def spans(found):
        n = F.floor((F.size(found) - 1) / F.lit(BLOCK)).cast("int")
        parts = F.transform(F.sequence(F.lit(0), n), lambda i: F.slice(found, i * BLOCK + 1, BLOCK))
        return F.flatten(F.aggregate(parts, begin, block)["blocks"])

    # As the element of an array the matches are found once, however often they are named below it.
    found = F.get(F.transform(F.array(cells), spans), F.lit(0))
    return F.when(text.rlike(NEEDED[kind]), found).otherwise(none)


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        small = lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        digits = F.regexp_replace(value, "[ -]", "")
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _by_kind(kind: Column, made) -> Column:
    out = F.lit(None)
    for k in reversed(KINDS):
        out = F.when(kind == k, made(k)).otherwise(out)
    return out


def _votes(text: Column, s: Column) -> dict[str, Column]:
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    before = F.lower(F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)).cast("int"), F.least(s["start"], F.lit(CONTEXT)).cast("int")))
    left = F.when(s["start"] > 0, F.substring(text, s["start"].cast("int"), F.lit(1))).otherwise(F.lit(" "))
    right = F.substring(text, (s["end"] + 1).cast("int"), F.lit(1))
    open_left, open_right = ~left.rlike(r"[\p{L}0-9._@/-]"), ~right.rlike(r"[\p{L}0-9_@/-]")
    return {
        "format": _by_kind(s["kind"], lambda k: F.when(s["value"].rlike(FORMAT[k]), yes).otherwise(no)),
        "gazetteer": _by_kind(s["kind"], lambda k: F.when(s["value"].rlike(GAZETTEER[k]), yes).otherwise(no if k in ("email", "iban") else none)),
        "before": _by_kind(s["kind"], lambda k: F.when(before.rlike(BEFORE[k]), yes).otherwise(none)),
        "neighbours": F.when(open_left & open_right, yes).otherwise(no),
        "placeholder": F.when(s["value"].rlike(PLACEHOLDER), no).otherwise(none),
    }


def _length_class(s: Column) -> Column:
    """0 to 7: the bits of the span's length."""
    return F.least(F.floor(F.log2((s["end"] - s["start"]).cast("double"))), F.lit(7)).cast("int")


def _described(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with base and candidates, arrays of spans; candidates carry their votes."""
    text = F.col("__text")
    one = docs.withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    one = one.withColumn("__base", F.array_sort(F.concat(*[_spans(text, k) for k in BASE])))
    return one.withColumn("__extra", F.array_sort(F.concat(*[_spans(text, k) for k in EXTRA])))


def _with_votes(text: Column, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            *[s[f].alias(f) for f in ("start", "rank", "end", "kind", "value")],
            F.struct(*[v.alias(k) for k, v in _votes(text, s).items()]).alias("votes"),
            _length_class(s).alias("size"),
        ),
    )


def estimate(cells: list[tuple], rounds: int = 60) -> dict[tuple, float]:
    """Posterior per (kind, votes) from (kind, votes, count) cells: one prior and one table of vote rates per kind and class."""
    out: dict[tuple, float] = {}
    for kind in {c[0] for c in cells}:
        own = [(v, n) for k, v, n in cells if k == kind]
        total = sum(n for _, n in own)
        prior = 0.7
        rates = [[{1: 0.6, 0: 0.3, -1: 0.1}, {1: 0.2, 0: 0.4, -1: 0.4}] for _ in LABELERS]
        for _ in range(rounds):
            post = []
            for votes, _n in own:
                a, b = math.log(prior), math.log(1 - prior)
                for j, v in enumerate(votes):
                    a, b = a + math.log(rates[j][0][v]), b + math.log(rates[j][1][v])
                post.append(1 / (1 + math.exp(min(700, b - a))))
            good = sum(p * n for p, (_, n) in zip(post, own))
            prior = min(0.99, max(0.01, (good + 7) / (total + 10)))
            for j in range(len(LABELERS)):
                for c, start in ((0, {1: 6, 0: 3, -1: 1}), (1, {1: 2, 0: 4, -1: 4})):
                    sums = dict(start)
                    for p, (votes, n) in zip(post, own):
                        sums[votes[j]] += n * (p if c == 0 else 1 - p)
                    whole = sum(sums.values())
                    rates[j][c] = {v: x / whole for v, x in sums.items()}
        out.update({(kind, votes): p for (votes, _), p in zip(own, post)})
    return out


def fit(cells: list[tuple], rounds: int = 300, rate: float = 0.5) -> dict[tuple, float]:
    """Logistic weights of the features of (kind, votes, size, posterior, count) cells, by full gradients."""
    weights: dict[tuple, float] = {}
    total = sum(c[4] for c in cells) or 1
    rows = [(_features(k, v, s), p, n / total) for k, v, s, p, n in cells]
    for _ in range(rounds):
        grads: dict[tuple, float] = {}
        for names, p, share in rows:
            z = sum(weights.get(f, 0.0) for f in names)
            err = share * (1 / (1 + math.exp(-max(-700, min(700, z)))) - p)
            for f in names:
                grads[f] = grads.get(f, 0.0) + err
        for f, g in grads.items():
            weights[f] = weights.get(f, 0.0) * (1 - 1e-3 * rate) - rate * 8 * g
    return weights


def _features(kind: str, votes: tuple, size: int) -> list[tuple]:
    return [("kind", kind), ("size", kind, size), *[(name, kind, v) for name, v in zip(LABELERS, votes)]]


def _score(s: Column, weights: dict[tuple, float]) -> Column:
    names = F.array(
        F.concat_ws("/", F.lit("kind"), s["kind"]),
        F.concat_ws("/", F.lit("size"), s["kind"], s["size"]),
        *[F.concat_ws("/", F.lit(name), s["kind"], s["votes"][name]) for name in LABELERS],
    )
    table = {"/".join(map(str, f)): w for f, w in weights.items()} or {"": 0.0}
    lookup = F.create_map(*[F.lit(x) for pair in sorted(table.items()) for x in pair])
    z = F.aggregate(names, F.lit(0.0), lambda acc, n: acc + F.coalesce(F.try_element_at(lookup, n), F.lit(0.0)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def learn(docs: DataFrame, text_col: str = "text") -> dict[tuple, float]:
    """Classifier weights from the votes on all candidates. At most 9 kinds * 3^5 votes * 8 lengths counts are collected."""
    one = _described(docs, text_col).filter(F.size("__base") + F.size("__extra") > 0)
    span = one.select(F.explode(_with_votes(F.col("__text"), F.concat("__base", "__extra"))).alias("s"))
    counted = span.groupBy(F.col("s.kind"), *[F.col(f"s.votes.{n}").alias(n) for n in LABELERS], F.col("s.size").alias("size")).count()
    got = [(r["kind"], tuple(r[n] for n in LABELERS), r["size"], r["count"]) for r in counted.collect()]
    sums: dict[tuple, int] = {}
    for kind, votes, _, n in got:
        sums[kind, votes] = sums.get((kind, votes), 0) + n
    posterior = estimate([(k, v, n) for (k, v), n in sorted(sums.items())])
    return fit(sorted((k, v, s, posterior[k, v], n) for k, v, s, n in got))


def find_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with base_spans and all_spans: arrays of (start, rank, end, kind, value), ascending, code points, end exclusive.

    A NULL or empty text has none. Rows come back one to one with all their columns; repeated rows and NULL ids are
    rows like any other. An empty frame learns nothing and stays empty. Columns of ``docs`` named base_spans or
    all_spans are replaced.
    """
    weights = learn(docs, text_col)
    one = _described(docs.drop("base_spans", "all_spans"), text_col)
    fresh = F.filter("__extra", lambda e: ~F.exists("__base", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"])))
    good = F.filter(_with_votes(F.col("__text"), fresh), lambda s: _score(s, weights) >= 0.5)
    plain = F.transform(good, lambda s: F.struct(*[s[f].alias(f) for f in ("start", "rank", "end", "kind", "value")]))
    added = F.when(F.size("__extra") > 0, plain).otherwise(F.col("__extra"))
    one = one.withColumn("base_spans", F.col("__base")).withColumn("all_spans", F.array_sort(F.concat("__base", added)))
    return one.drop("__text", "__base", "__extra")


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span's text replaced by <KIND>; of overlapping spans the first names the run. NULL texts stay."""
    found = find_personal_data(docs, text_col)
    text = F.col(text_col)

    def step(acc, s):
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = F.concat(acc["out"], gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        out = F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    done = F.aggregate("all_spans", start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return found.withColumn(text_col, F.when(F.size("all_spans") > 0, done).otherwise(text)).drop("base_spans", "all_spans")
