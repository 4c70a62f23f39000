"""Weighted keyword rules over messages; the rules are data.

A rule starts from its priority. Each keyword adds points for where it stands, exclusions take
some away, and of a rule's subtopics the one with most points names the message. Rules are
evaluated with higher-order functions over literal arrays, so that generated code does not grow
with the number of keywords.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from missiva.functions import text as T
from missiva.operators.archive import system_noise

# Points, and names of what is no topic.
SUBJECT, PHRASE, FOLDER, BODY, ANYWHERE, EXCLUDED = 7.0, 1.0, 4.5, 2.5, 0.5, 4.0
SUB_SUBJECT, SUB_FOLDER, SUB_BODY = 5.0, 2.0, 1.5
MANUAL, NOISE, NOISE_SUB, NO_SUBTOPIC = "לבדיקה ידנית", "מערכת / רעש", "הודעות מערכת", "ללא תת-נושא"
HYBRID_CONFIDENCE = 0.75


@dataclass(frozen=True)
class Rule:
    name: str
    keywords: list[str]
    priority: int = 0
    subtopics: list[tuple[str, list[str]]] = field(default_factory=list)
    excluded: list[str] = field(default_factory=list)


#: Rules of our own for the archive of a pension fund; real deployments pass theirs.
RULES = [
    Rule("pension", ["pension", "early retirement", "supplementary pension", "פנסיה", "פרישה מוקדמת", "קצבה"], 3, [("early", ["early retirement", "פרישה מוקדמת"]), ("supplementary", ["supplementary pension", "הקצבה המשלימה"])]),
    Rule("claims", ["disability claim", "survivor benefits", "claim", "תביעת הנכות", "קצבת השאירים"], 2, [("disability", ["disability", "הנכות"]), ("survivors", ["survivor", "השאירים"])]),
    Rule("documents", ["tax certificate", "annual statement", "form 161", "salary slip", "אישור המס", "הדוח השנתי", "תלוש השכר"], 1, [("tax", ["tax certificate", "אישור המס"]), ("salary", ["salary slip", "תלוש השכר"])], ["printer"]),
    Rule("payments", ["payment", "amount of", "תשלום", "הסכום"], 1),
    Rule("meetings", ["meeting", "the room is booked", "פגישה", "שיחה על"], 0),
]


def _clean(word: str) -> str:
    """A keyword as the search text has it."""
    return " ".join("".join(c if c.isalnum() or c in "_ \n" or "֐" <= c <= "׿" else " " for c in word.lower()).split())


def search_texts() -> Column:
    """A struct ``subject, body, folder, sender, all`` of a mail's search texts."""
    body = F.coalesce(F.nullif(F.col("clean_body"), F.lit("")), F.col("body"))
    base = F.struct(T.search_text(T.normalize_subject("subject")).alias("subject"), T.search_text(body).alias("body"), T.search_text("folder_path").alias("folder"), T.search_text("from_email").alias("sender"))

    def joined(x: Column) -> Column:
        parts = F.array(*[F.nullif(c, F.lit("")) for c in (x["subject"], F.substring(x["body"], 1, 6000), x["folder"], x["sender"])])
        return F.struct(*[x[k].alias(k) for k in ("subject", "body", "folder", "sender")], F.array_join(F.array_compact(parts), " ").alias("all"))

    return T.let(base, joined)


def is_noise(x: Column) -> Column:
    return system_noise(x["subject"], x["body"], x["folder"], x["sender"])


def _points(x: Column, word: Column, phrase: Column | None, subject: float, folder: float, body: float, anywhere: float) -> Column:
    """Points of one keyword in the search texts ``x``."""
    at = lambda k, p: F.when(F.contains(x[k], word), p).otherwise(F.lit(0.0))
    first = F.lit(subject) if phrase is None else F.lit(subject) + F.when(phrase, F.lit(PHRASE)).otherwise(F.lit(0.0))
    return at("subject", first) + at("folder", F.lit(folder)) + at("body", F.lit(body)) + (at("all", F.lit(anywhere)) if anywhere else F.lit(0.0))


def _one(f):
    """f as a function of one argument only; higher-order functions count the arguments."""
    return lambda t: f(t)


def rule_scores(x: Column, rules: list[Rule] = RULES) -> Column:
    """An array with a struct ``name, ord, priority, score, matched, subtopic`` of each rule, from the search texts ``x``."""
    out = []
    for k, r in enumerate(rules):
        words = [(w, _clean(w)) for w in r.keywords if _clean(w)]
        score, total = F.lit(float(r.priority)), F.struct(F.lit(0.0).alias("s"), F.array().cast("array<string>").alias("m"))
        if words:
            each = F.transform(
                F.array(*[F.struct(F.lit(w).alias("w"), F.lit(n).alias("n"), F.lit(" " in n).alias("p")) for w, n in words]),
                lambda k: F.struct(k["w"].alias("w"), _points(x, k["n"], k["p"], SUBJECT, FOLDER, BODY, ANYWHERE).alias("s")),
            )
            total = T.let(F.filter(each, lambda k: k["s"] > 0), lambda hits: F.struct(F.aggregate(hits, F.lit(0.0), lambda a, k: a + k["s"]).alias("s"), F.transform(hits, lambda k: k["w"]).alias("m")))
        if r.excluded:
            score = score - F.size(F.filter(F.array(*[F.lit(_clean(w)) for w in r.excluded]), lambda w: F.contains(x["all"], w))) * EXCLUDED
        subtopic = F.lit("")
        if r.subtopics:
            subs = F.transform(
                F.array(*[F.struct(F.lit(-i).alias("o"), F.lit(n).alias("name"), F.array(*[F.lit(_clean(w)) for w in ws if _clean(w)]).alias("ws")) for i, (n, ws) in enumerate(r.subtopics)]),
                lambda t: F.struct(F.aggregate(t["ws"], F.lit(0.0), lambda a, w: a + _points(x, w, None, SUB_SUBJECT, SUB_FOLDER, SUB_BODY, 0.0)).alias("s"), t["o"].alias("o"), t["name"].alias("name")),
            )
            subtopic = T.let(F.array_max(subs), lambda best: F.when(best["s"] > 0, best["name"]).otherwise(F.lit("")))

        def filled(t: Column, r: Rule = r, k: int = k, score: Column = score, subtopic: Column = subtopic) -> Column:
            return F.struct(F.lit(r.name).alias("name"), F.lit(k).alias("ord"), F.lit(r.priority).alias("priority"), (score + t["s"]).alias("score"), t["m"].alias("matched"), subtopic.alias("subtopic"))

        out.append(T.let(total, _one(filled)))
    return F.array(*out)


def fallback_subtopic(subject: Column, matched: Column) -> Column:
    """The longest matched term, else the first words of the subject."""
    terms = F.filter(F.transform(matched, T.strip), lambda t: t != "")
    longest = F.array_max(F.transform(terms, lambda t, i: F.struct(F.length(t).alias("n"), (-i).alias("o"), t.alias("t"))))["t"]
    short = F.array_join(F.slice(F.split(T.subject_snippet(subject, 80), rf"[{T.WS}]+"), 1, 6), " ")
    return F.coalesce(F.substring(longest, 1, 80), F.nullif(short, F.lit("")), F.lit(NO_SUBTOPIC))


def classify(mail: DataFrame, mode: str = "rules", rules: list[Rule] = RULES, min_score: float = 4.0) -> DataFrame:
    """Add knowledge_topic, _subtopic, _score, _matched_terms, _mode, _review_required and is_system_noise.

    mode: rules, llm, cluster, or hybrid (the LLM's topic where its confidence is high enough).
    The best rule has the highest score, then the highest priority, then comes first; below
    ``min_score`` a message goes to manual review.
    """
    llm = lambda c: T.normalize_whitespace(F.coalesce(F.col(c), F.lit("")))
    if "llm_confidence" not in mail.columns:
        mail = mail.withColumn("llm_confidence", F.lit(None).cast("double"))
    llm_sub = T.strip(F.coalesce(F.col("llm_subtopic"), F.lit("")))

    def by_rule(x: Column) -> Column:
        def told(best: Column) -> Column:
            review = best["score"] < min_score
            return F.struct(
                F.when(review, MANUAL).otherwise(best["name"]).alias("topic"),
                F.coalesce(F.when(~review, F.nullif(best["subtopic"], F.lit(""))), F.nullif(llm_sub, F.lit("")), fallback_subtopic(F.col("subject"), best["matched"])).alias("subtopic"),
                F.when(review, F.greatest(best["score"], F.lit(0.0))).otherwise(best["score"]).alias("score"), best["matched"].alias("matched"), review.alias("review"), F.lit("rules").alias("mode"),
            )

        ranked = F.transform(rule_scores(x, rules), lambda r: F.struct(r["score"].alias("score"), r["priority"].alias("priority"), (-r["ord"]).alias("o"), r["name"].alias("name"), r["matched"].alias("matched"), r["subtopic"].alias("subtopic")))
        return T.let(F.array_max(ranked), told)

    none = F.array().cast("array<string>")

    def named(topic: Column, mode: str, score: Column) -> Column:
        return F.struct(topic.alias("topic"), F.coalesce(F.nullif(llm_sub, F.lit("")), T.subject_snippet("subject")).alias("subtopic"), score.alias("score"), none.alias("matched"), F.lit(False).alias("review"), F.lit(mode).alias("mode"))

    some = lambda c: F.nullif(c, F.lit(""))
    if mode == "llm":
        match = lambda x: named(F.coalesce(some(llm("llm_topic")), some(llm("cluster_name")), F.lit(MANUAL)), "llm", F.lit(1.0))
    elif mode == "cluster":
        match = lambda x: named(F.coalesce(some(llm("cluster_name")), some(llm("llm_topic")), F.lit(MANUAL)), "cluster", F.lit(1.0))
    elif mode == "hybrid":
        sure = (llm("llm_topic") != "") & (T.as_float(F.col("llm_confidence").cast("string")) >= HYBRID_CONFIDENCE)
        match = lambda x: F.when(sure, named(llm("llm_topic"), "llm", T.as_float(F.col("llm_confidence").cast("string")))).otherwise(by_rule(x))
    else:
        match = by_rule
    noise = F.struct(F.lit(NOISE).alias("topic"), F.lit(NOISE_SUB).alias("subtopic"), F.lit(0.0).alias("score"), none.alias("matched"), F.lit(False).alias("review"), F.lit("rules").alias("mode"))
    # The condition is always true; being non-deterministic it keeps later filters from copying the whole classification into themselves.
    once = F.monotonically_increasing_id() >= 0
    rows = mail.withColumn("_m", F.when(once, T.let(search_texts(), lambda x: F.when(is_noise(x), noise).otherwise(match(x)))))
    return rows.withColumns({
        "knowledge_topic": F.col("_m.topic"), "knowledge_subtopic": F.col("_m.subtopic"), "knowledge_score": F.col("_m.score"), "knowledge_matched_terms": F.array_join("_m.matched", "; "),
        "knowledge_mode": F.col("_m.mode"), "knowledge_review_required": F.col("_m.review"), "is_system_noise": F.col("_m.topic") == NOISE, "body_for_pack": F.coalesce(F.nullif(F.col("clean_body"), F.lit("")), F.col("body")),
    }).drop("_m")


def hits_topic(topics: dict[str, list[str]], subject: Column, text: Column, default: Column) -> Column:
    """The topic with most hits (three for a term in the subject, else one for one in the text); ties go to the first."""
    score = lambda ws: F.aggregate(F.array(*[F.lit(w.lower()) for w in ws]), F.lit(0), lambda a, w: a + F.when(F.contains(subject, w), 3).when(F.contains(text, w), 1).otherwise(0))
    best = F.array_max(F.array(*[F.struct(score(ws).alias("s"), F.lit(-i).alias("o"), F.lit(n).alias("name")) for i, (n, ws) in enumerate(topics.items())]))
    return F.when(best["s"] > 0, best["name"]).otherwise(default)
