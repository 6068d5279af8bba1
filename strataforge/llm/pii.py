"""Personal data by weak supervision.

Strict and loose regular expressions propose spans. Four labelers vote on
each: the strict form, a gazetteer (top-level domains, dialling prefixes,
issuer prefixes, unusable address blocks), the words before the span, and
the shape of its surroundings. Expectation-maximisation over the counts of
vote patterns (at most kinds x 3**4 rows, whatever the input) estimates each
labeler's reliability per kind. The resulting soft labels train the final
span classifier, a naive Bayes model over bucketed features (a fixed number
of cells). Strict spans always stay; a loose span is added when the
classifier gives it at least ``ACCEPT`` and it touches no strict one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm.common import id_text
from strataforge.llm.spans import joined, plain, with_spans
from strataforge.session import ensure_checkpoint_dir

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
#: Fixed values. Strict forms: a match starts where its run starts or where the last match ended, which is where a
#: leftmost search starts it, so long runs are read once; possessive groups keep the matcher's stack flat.
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Fixed values. Loose forms, only added when the classifier accepts them.
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]{{1,63}}(?:\x20?(?:[(\[](?:dot|DOT)[)\]]|\.)\x20?[A-Za-z0-9-]{{2,63}}){{1,4}}",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9.-])",
}
#: Words before a span that speak for its kind.
CUES = {
    "email": "mail|contact|write|reach|kontakt|correo|courriel|adresse",
    "ip": "ip|host|server|address|addr|client|login|from",
    "card": "card|visa|master|amex|credit|debit|karte|carte|tarjeta|pay",
    "phone": "phone|tel|call|fax|mobile|cell|contact|whatsapp|handy|telefon",
}
#: What a gazetteer knows of each kind (condition on the span ``s``).
GAZETTEER = {
    "email": r"lower(s.match) rlike '(com|org|net|edu|gov|io|info|de|fr|es|uk|eu|it|nl|ch|at|us|ca|mx|example)$'",
    "ip": r"NOT s.match rlike '^(0|22[4-9]|2[3-5][0-9])\\.'",
    "card": r"regexp_replace(s.match, '[^0-9]', '') rlike '^(4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)'",
    "phone": r"s.match rlike '^[+](1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])' OR s.match rlike '^[(]?[2-9][0-9]{2}'",
}
LABELERS = ("strict", "gazetteer", "context", "shape")
ACCEPT = 0.9
EM_ROUNDS = 30
_DIGITS = "regexp_replace(s.match, '[^0-9]', '')"
_LUHN = (f"aggregate(sequence(1, length({_DIGITS})), 0, (a, i) -> a + CASE WHEN i % 2 = 1 "
         f"THEN CAST(substring({_DIGITS}, -i, 1) AS int) ELSE CASE WHEN CAST(substring({_DIGITS}, -i, 1) AS int) > 4 "
         f"THEN 2 * CAST(substring({_DIGITS}, -i, 1) AS int) - 9 ELSE 2 * CAST(substring({_DIGITS}, -i, 1) AS int) END END) % 10 = 0")
#: A strict match that fails its condition is dropped, without another try.
VALID = {
    "email": "true",
    "ip": ("forall(split(s.match, '[.]'), p -> length(ltrim('0', p)) <= 3 "
           "AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255)"),
    "card": f"CASE WHEN length({_DIGITS}) BETWEEN 12 AND 19 THEN {_LUHN} ELSE false END",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
}
_ROW = ("start int, end int, rank int, kind string, strict int, gazetteer int, context int, shape int, "
        "f_len int, f_cue int, f_left int, f_right int, f_digits int")


def _votes(kind: str, spans: str, strict: bool) -> str:
    """SQL: spans of one kind with their votes (1 for, 0 against, -1 abstains) and bucketed features."""
    keep = VALID[kind] if strict else "true"
    cue = f"lower(s.before) rlike '({CUES[kind]})[^a-z0-9]*[^0-9@]{{0,12}}$'"
    clean = "(s.before = '' OR s.before rlike '[^A-Za-z0-9@._+-]$') AND (s.after = '' OR s.after rlike '^([^A-Za-z0-9@_+-])')"
    glued = "s.before rlike '[0-9][.:/-]?$' OR s.after rlike '^[.:/-]?[0-9]'"
    return (f"transform(filter({spans}, s -> {keep}), s -> named_struct('start', s.start, 'end', s.end, "
            f"'rank', {KINDS.index(kind)}, 'kind', '{kind}', 'strict', {1 if strict else -1}, "
            f"'gazetteer', CASE WHEN {GAZETTEER[kind]} THEN 1 ELSE 0 END, "
            f"'context', CASE WHEN {cue} THEN 1 ELSE -1 END, "
            f"'shape', CASE WHEN {clean} THEN 1 WHEN {glued} THEN 0 ELSE -1 END, "
            f"'f_len', least(CAST(length(s.match) / 4 AS int), 12), 'f_cue', CASE WHEN {cue} THEN 1 ELSE 0 END, "
            f"'f_left', CASE WHEN s.before = '' THEN 0 WHEN s.before rlike '\\\\s$' THEN 1 WHEN s.before rlike '[A-Za-z0-9]$' THEN 2 ELSE 3 END, "
            f"'f_right', CASE WHEN s.after = '' THEN 0 WHEN s.after rlike '^\\\\s' THEN 1 WHEN s.after rlike '^[A-Za-z0-9]' THEN 2 ELSE 3 END, "
            f"'f_digits', least(length({_DIGITS}), 20)))")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, loose): strict and loose spans with votes and features, one pass over the texts.
    Loose spans that touch a strict one are left out."""
    t = id_text(docs, id_col, text_col).select("doc_id", plain(F.col("text")).alias("text"))
    s = with_spans(t, "text", {**STRICT, **{f"l_{k}": p for k, p in LOOSE.items()}})
    s = s.select("doc_id",
                 F.concat(*[F.expr(_votes(k, k, True)) for k in KINDS]).alias("base"),
                 F.concat(*[F.expr(_votes(k, f"l_{k}", False)) for k in LOOSE]).alias("loose"))
    return s.withColumn("loose", F.expr(
        "CASE WHEN size(loose) = 0 THEN loose ELSE filter(loose, x -> NOT exists(base, b -> b.start < x.end AND x.start < b.end)) END"))


def em(counts: list[tuple[tuple[int, ...], float]], rounds: int = EM_ROUNDS) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Two-class latent model over vote patterns and their counts: the share of
    true spans and, per labeler, vote -> (P(vote | true), P(vote | false)).
    Starts from the majority vote; no rows give an even prior."""
    k = len(LABELERS)
    total = sum(n for _, n in counts)
    if not total:
        return 0.5, [{v: (1 / 3, 1 / 3) for v in (-1, 0, 1)}] * k
    post = {p: (1 + sum(v == 1 for v in p)) / (2 + sum(v >= 0 for v in p)) for p, _ in counts}
    for _ in range(rounds):
        prior = min(max(sum(n * post[p] for p, n in counts) / total, 0.01), 0.99)
        rel = []
        for j in range(k):
            yes, no = {v: 0.5 for v in (-1, 0, 1)}, {v: 0.5 for v in (-1, 0, 1)}
            for p, n in counts:
                yes[p[j]] += n * post[p]
                no[p[j]] += n * (1 - post[p])
            sy, sn = sum(yes.values()), sum(no.values())
            rel.append({v: (yes[v] / sy, no[v] / sn) for v in yes})
        post = {p: posterior(p, prior, rel) for p, _ in counts}
    return prior, rel


def posterior(pattern, prior: float, rel) -> float:
    z = math.log(prior / (1 - prior)) + sum(math.log(rel[j][v][0] / rel[j][v][1]) for j, v in enumerate(pattern))
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


FEATURES = ("f_len", "f_cue", "f_left", "f_right", "f_digits")


def fit(cand: DataFrame) -> tuple[dict, dict]:
    """EM per kind, then naive Bayes weights: (kind -> log odds of the prior, (kind, feature, value) -> log odds).
    What reaches the driver is bounded by the vote patterns and by the feature cells."""
    rows = cand.select(F.explode(F.concat("base", "loose")).alias("s")).select("s.*")
    counts = rows.groupBy("kind", *LABELERS).count().collect()
    soft, prior = {}, {}
    for kind in KINDS:
        mine = [(tuple(r[x] for x in LABELERS), float(r["count"])) for r in counts if r["kind"] == kind]
        p0, rel = em(mine)
        total = sum(n for _, n in mine)
        post = {p: posterior(p, p0, rel) for p, _ in mine}
        soft |= {(kind, *p): v for p, v in post.items()}
        share = min(max(sum(n * post[p] for p, n in mine) / total, 0.01), 0.99) if total else 0.5
        prior[kind] = math.log(share / (1 - share))
    if not soft:
        return prior, {}
    label = F.create_map(*[x for k, v in soft.items() for x in (F.lit("|".join(map(str, k))), F.lit(float(v)))])
    rows = rows.withColumn("p", label[F.concat_ws("|", "kind", *LABELERS)])
    cells = (rows.select("kind", "p", F.explode(F.array(*[
        F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in FEATURES])).alias("x"))
        .groupBy("kind", "x.f", "x.v").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect())
    total = {}
    for r in cells:
        y, n = total.get((r["kind"], r["f"]), (0.0, 0.0))
        total[r["kind"], r["f"]] = (y + r["yes"] + 1, n + r["no"] + 1)
    weight = {}
    for r in cells:
        y, n = total[r["kind"], r["f"]]
        weight[r["kind"], r["f"], r["v"]] = math.log((r["yes"] + 1) / y) - math.log((r["no"] + 1) / n)
    return prior, weight


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """(doc_id, base, spans): arrays of struct<start, rank, kind, end>, one row per row of ``docs``.

    Null and empty texts have no spans; equal rows give equal results; with
    no candidate anywhere nothing is trained and nothing is added.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    cand = candidates(docs, id_col, text_col).checkpoint()
    prior, weight = fit(cand)
    slim = "transform({}, x -> named_struct('start', x.start, 'rank', x.rank, 'kind', x.kind, 'end', x.end))"
    if weight:
        table = F.create_map(*[x for k, v in weight.items() for x in (F.lit("|".join(map(str, k))), F.lit(float(v)))])
        base = F.create_map(*[x for k, v in prior.items() for x in (F.lit(k), F.lit(float(v)))])
        cut = math.log(accept / (1 - accept))
        ok = F.filter("loose", lambda x: (base[x["kind"]] + sum(
            (F.coalesce(table[F.concat_ws("|", x["kind"], F.lit(f), x[f])], F.lit(0.0)) for f in FEATURES), F.lit(0.0))) >= cut)
    else:
        ok = F.col("loose")
    return (cand.withColumn("loose", F.when(F.size("loose") > 0, ok).otherwise(F.col("loose")))
            .select("doc_id", F.expr(slim.format("base")).alias("base"),
                    F.expr(slim.format("concat(base, loose)")).alias("spans")))


def digest(found: DataFrame) -> DataFrame:
    """Counts and span strings per document from ``find``'s rows."""
    return found.select(
        "doc_id", *[F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in KINDS],
        F.expr(f"sha2(CAST({joined('base')} AS binary), 256)").alias("base_sha256"), F.expr(joined("spans")).alias("spans"))
