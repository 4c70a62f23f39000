"""The mail queries in SQL, written apart from the column expressions; the drivers compare both."""

from __future__ import annotations

from missiva.functions.text import ENTITIES, NO_TITLE, PREFIXES, WS, WSL
from missiva.operators import archive as A
from missiva.operators import classify as C
from missiva.operators import learning as L
from missiva.operators import packing as P
from missiva.operators.cleaning import QUOTED_LINE, REPLY_LINES, SIGNATURE_LINES


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(c: str, pattern: str, to: str = "''") -> str:
    return f"regexp_replace({c}, {q(pattern)}, {to}, 'g')"


def strip(c: str) -> str:
    return rx(c, rf"\A[{WS}]+|[{WS}]+\z")


def ws(c: str) -> str:
    t = rx(rx(c, r"\r\n?", "chr(10)"), "[ \t]+", "' '")
    t = rx(rx(t, rf"(\A|\n)[{WSL}]+", r"'\1'"), rf"[{WSL}]+(\n|\z)", r"'\1'")
    return strip(rx(t, r"\n{3,}", "chr(10) || chr(10)"))


def subject(c: str) -> str:
    t = rx(f"coalesce({c}, '')", "[‏‎]")
    t = rx(t, rf"(?i)\A[{WS}]*(?:(?:{PREFIXES})[{WS}]*[:：][{WS}]*)+")
    t = rx(t, r"(?i)\[[^\]]*(?:external|חיצוני)[^\]]*\]")
    return f"lower({strip(rx(t, f'[{WS}]+', q(' ')))})"


def search_text(c: str) -> str:
    t = rx(f"lower({ws(f'coalesce({c}, {q(str())})')})", rf"[^\pL\pN_{WS}\x{{590}}-\x{{5ff}}]+", "' '")
    return strip(rx(t, f"[{WS}]+", "' '"))


def date_text(c: str) -> str:
    return f"coalesce(strftime({c} AT TIME ZONE 'UTC', '%d/%m/%Y'), '')"


def iso(c: str, t: str = "T") -> str:
    return f"strftime({c} AT TIME ZONE 'UTC', '%Y-%m-%d{t}%H:%M:%S') || CASE WHEN epoch_us({c}) % 1000000 <> 0 THEN strftime({c} AT TIME ZONE 'UTC', '.%f') ELSE '' END || '+00:00'"


def word(text: str, words: list[str]) -> str:
    alternatives = "|".join(w.lower().replace(".", r"\.") for w in words)
    return f"regexp_matches({text}, {q(rf'(?i)(^|[^{chr(92)}pL{chr(92)}pN{chr(92)}pM_])({alternatives})($|[^{chr(92)}pL{chr(92)}pN{chr(92)}pM_])')})"


def count_of(text: str, mark: str) -> str:
    return f"((length({text}) - length(replace({text}, {q(mark)}, ''))) / {len(mark)}.0)"


def matching(text: str, pattern: str) -> str:
    return f"(length({text}) - length({rx(text, pattern)}))"


def jpart(c: str) -> str:
    return f"coalesce(CAST(to_json({c}) AS VARCHAR), 'null')"


def stable(*parts: str) -> str:
    return f"sha256('[' || {' || {} || '.format(q(', ')).join(parts)} || ']')"


MAIL = f"""
WITH mail AS (
  SELECT ingest_seq, coalesce(message_id, '') AS message_id, sent_at AS date_sort, coalesce(subject_raw, '') AS subject, coalesce(subject_normalized, '') AS subject_normalized,
    coalesce(body_text_raw, '') AS body, coalesce(body_text_clean, '') AS clean_body, coalesce(sender_email, '') AS from_email,
    coalesce(array_to_string(to_emails, ';'), '') AS to_emails, coalesce(array_to_string(cc_emails, ';'), '') AS cc_emails, coalesce(array_to_string(bcc_emails, ';'), '') AS bcc_emails,
    coalesce(source_folder, '') AS folder_path, coalesce(source_folder, '') AS cluster_name, coalesce(llm_topic, '') AS llm_topic, coalesce(llm_subtopic, '') AS llm_subtopic,
    CASE WHEN is_duplicate THEN 'True' ELSE 'False' END AS is_filtered,
    coalesce(parent_record_message_id, '') AS parent_record_message_id, nested_depth, coalesce(container_attachment_filename, '') AS container_attachment_filename
  FROM messages)
"""

_WHO = "list_sort(list_filter(list_concat([sender_email], coalesce(to_emails, []), coalesce(cc_emails, [])), lambda x: x IS NOT NULL AND x <> ''))"
_WHO_JSON = f"('[' || array_to_string(list_transform({_WHO}, lambda x: CAST(to_json(x) AS VARCHAR)), ', ') || ']')"
_META = stable(jpart("coalesce(subject_normalized, '')"), _WHO_JSON, jpart("strftime(sent_at AT TIME ZONE 'UTC', '%Y-%m-%d')"), jpart("content_hash"))
_WEEK = "printf('%d-W%02d', isoyear({0} AT TIME ZONE 'UTC'), week({0} AT TIME ZONE 'UTC'))"
_AT = "coalesce(sent_at, received_at)"
KEYS = f"""
WITH k AS (SELECT *, CASE WHEN message_id <> '' THEN 'message-id:' || lower(message_id) ELSE 'metadata:' || {_META} END AS dedup_key, coalesce({iso(_AT)}, '') AS order_date FROM messages)
"""
TOPICS = {r.name: r.keywords for r in C.RULES}


def _ordered_case(text: str, lists: dict[str, list[str]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {word(text, ws_)} THEN {q(n)}" for n, ws_ in lists.items()) + f" ELSE {other} END"


def _best_topic(subject_: str, text: str, other: str, by_subject: bool) -> str:
    """A list of (score, -order, name), its maximum, and its name where the score is positive."""
    items = []
    for i, (n, words) in enumerate(TOPICS.items()):
        points = " + ".join((f"CASE WHEN contains({subject_}, {q(w.lower())}) THEN 3 WHEN contains({text}, {q(w.lower())}) THEN 1 ELSE 0 END" if by_subject else f"CAST(contains({text}, {q(w.lower())}) AS INT)") for w in words)
        items.append(f"{{'s': {points}, 'o': {-i}, 'name': {q(n)}}}")
    return f"(SELECT CASE WHEN b.s > 0 THEN b.name ELSE {other} END FROM (SELECT list_max([{', '.join(items)}]) AS b))"


def _summary(by: str, value: str, k: int, name: str, out: str, source: str = "mail") -> str:
    return f""", counted AS (SELECT {by} AS g, {value} AS v, count(*) AS n FROM {source} WHERE {strip(by)} <> '' GROUP BY ALL),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, v) AS rn FROM counted),
      tops AS (SELECT g, string_agg(v, '; ' ORDER BY rn) AS top FROM ranked WHERE rn <= {k} GROUP BY g)
      SELECT {by} AS {name}, count(*) AS email_count, {date_text('min(date_sort)')} AS first_date, {date_text('max(date_sort)')} AS last_date, any_value(tops.top) AS {out}
      FROM {source} JOIN tops ON tops.g = {by} WHERE {strip(by)} <> '' GROUP BY {by}"""


def _search(topic=None, person=None, query=None, limit=None) -> str:
    people, text = "concat_ws(' ', from_email, to_emails, cc_emails, bcc_emails)", "concat_ws(' ', subject, clean_body, body)"
    like = lambda c, v: f"regexp_matches({c}, {q('(?i)' + '.*'.join(w.replace('.', chr(92) + '.') for w in v.split()))})"
    where, score = ["true"], ["0"]
    hit = lambda c, v, p: f"CASE WHEN contains(lower({c}), {q(v.lower())}) THEN {p} ELSE 0 END"
    if topic:
        where.append(f"({like('cluster_name', topic)} OR {like('llm_subtopic', topic)} OR {like('subject', topic)})")
        score += [hit("cluster_name", topic, 50), hit("subject", topic, 20), hit("llm_subtopic", topic, 25)]
    if person:
        where.append(like(people, person))
        score += [hit("from_email", person, 40), hit("concat_ws(' ', to_emails, cc_emails, bcc_emails)", person, 15)]
    if query:
        where.append(like(text, query))
        score += [hit("subject", query, 25), hit("clean_body", query, 10)]
    end = f" ORDER BY search_score DESC, date_sort DESC NULLS LAST, message_id, ingest_seq LIMIT {limit}" if limit else ""
    rank = "CAST(row_number() OVER (ORDER BY search_score DESC, date_sort DESC NULLS LAST, message_id, ingest_seq) AS INT) AS rank, " if limit else ""
    return MAIL + f"SELECT {rank}ingest_seq, search_score FROM (SELECT *, {' + '.join(score)} AS search_score FROM mail WHERE {' AND '.join(where)}){end}"


def _fallback_subtopic() -> str:
    longest = "substr(list_reverse_sort(list_transform(string_split(nullif(best.matched, ''), ';'), lambda t, i: {'n': length(t), 'o': -i, 't': t}))[1].t, 1, 80)"
    short = f"coalesce(nullif(substr({ws(subject('subject'))}, 1, 80), ''), {q(NO_TITLE)})"
    return f"coalesce(nullif({longest}, ''), nullif(array_to_string(regexp_split_to_array({short}, {q(f'[{WS}]+')})[1:6], ' '), ''), {q(C.NO_SUBTOPIC)})"


def _rendered() -> str:
    """``r``: the mails that are packed with their rendered text."""
    body = f"CASE WHEN length(body_for_pack) > {P.MAX_BODY} THEN {rx(f'substr(body_for_pack, 1, {P.MAX_BODY})', f'[{WS}]+$')} || chr(10) || '[body truncated]' ELSE body_for_pack END"
    fields = [("Message ID", "message_id"), ("Date", date_text("date_sort")), ("From", "from_email"), ("To", "to_emails"), ("CC", "cc_emails"), ("BCC", "bcc_emails"), ("Subject", "subject"), ("Folder", "folder_path"), ("Topic", "knowledge_topic"), ("Subtopic", "knowledge_subtopic"), ("Matched terms", "knowledge_matched_terms")]
    text = " || chr(10) || ".join(["'EMAIL'", *(f"'{n}: ' || {c}" for n, c in fields), "''", "'Body:'", "CASE WHEN b = '' THEN '[empty body]' ELSE b END", "''", q(P.RULE), "''"])
    return f", bodies AS (SELECT *, {body} AS b FROM cl), r AS (SELECT *, {text} AS text FROM bodies)"


def _packs() -> str:
    """``packed``: a fold over each topic's mails in order, by recursion over their numbers."""
    start = _rules().replace("WITH mail", "WITH RECURSIVE mail", 1) + _rendered()
    return start + f""", o AS MATERIALIZED (SELECT knowledge_topic AS t, ingest_seq, length(text) AS chars, row_number() OVER (PARTITION BY knowledge_topic ORDER BY date_sort NULLS LAST, message_id, ingest_seq) AS n FROM r WHERE {_KEEP}),
      g AS (SELECT t, n, ingest_seq, chars, 1 AS part, 1 AS place, chars AS total FROM o WHERE n = 1
        UNION ALL
        SELECT o.t, o.n, o.ingest_seq, o.chars, CASE WHEN full_ THEN g.part + 1 ELSE g.part END, CASE WHEN full_ THEN 1 ELSE g.place + 1 END, CASE WHEN full_ THEN o.chars ELSE g.total + o.chars END
        FROM (SELECT g.*, n + 1 AS next FROM g) g JOIN o ON o.t = g.t AND o.n = g.next, LATERAL (SELECT g.place >= {P.MAX_EMAILS} OR g.total + o.chars > {P.MAX_CHARS} AS full_) f),
      packed AS (SELECT t AS knowledge_topic, ingest_seq, CAST(part AS INT) AS part, CAST(place AS INT) AS place, CAST(chars AS INT) AS chars FROM g),
      full_rows AS (SELECT cl.*, packed.part, packed.place FROM packed JOIN cl USING (ingest_seq)),
      slugs0 AS (SELECT DISTINCT knowledge_topic, replace(knowledge_topic, ' ', '_') AS slug FROM packed),
      slugs AS (SELECT knowledge_topic, CASE WHEN row_number() OVER (PARTITION BY lower(slug) ORDER BY knowledge_topic) > 1 THEN slug || '_' || row_number() OVER (PARTITION BY lower(slug) ORDER BY knowledge_topic) ELSE slug END AS slug FROM slugs0)
    """


def _tops(by: str, value: str, k: int, out: str, where: str = "true", shown: str | None = None) -> str:
    return f"(SELECT {by}, string_agg({shown or value}, '; ' ORDER BY rn) AS {out} FROM (SELECT {by}, {value}, count(*) AS n, row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, {value}) AS rn FROM full_rows WHERE {where} GROUP BY {by}, {value}) WHERE rn <= {k} GROUP BY {by})"


def _embedded() -> str:
    return MAIL + f", e AS (SELECT cluster_name, ingest_seq, subject, {ws('subject || chr(10) || subject || chr(10) || substr(body, 1, 3500)')} AS text FROM mail)"


_TOKENS = r"regexp_extract_all(lower(text), '[\x{590}-\x{5ff}A-Za-z0-9][\x{590}-\x{5ff}A-Za-z0-9_-]+')"


def _top_terms(source: str, k: int) -> str:
    stop = ", ".join(q(w) for w in L.STOPWORDS)
    return f", w AS (SELECT cluster_name, unnest({_TOKENS}) AS term FROM {source}), c AS (SELECT cluster_name, term, count(*) AS n FROM w WHERE length(term) > 2 AND term NOT IN ({stop}) GROUP BY ALL), tt AS (SELECT cluster_name, term, n, CAST(row_number() OVER (PARTITION BY cluster_name ORDER BY n DESC, term) AS INT) AS rank FROM c QUALIFY rank <= {k})"


def _representatives() -> str:
    return _embedded() + f""", t0 AS (SELECT *, {_TOKENS} AS ts FROM e),
      t1 AS (SELECT cluster_name, ingest_seq, unnest(list_concat(ts, list_transform(ts[:len(ts) - 1], lambda x, i: x || ' ' || ts[i + 1]))) AS t FROM t0),
      tf AS (SELECT cluster_name, ingest_seq, t, count(*) AS tf FROM t1 GROUP BY ALL),
      size AS (SELECT cluster_name, count(*) AS n FROM e GROUP BY 1),
      idf AS (SELECT cluster_name, t, ln((any_value(n) + 1) / (count(*) + 1)) + 1 AS idf, any_value(n) AS n FROM tf JOIN size USING (cluster_name) GROUP BY ALL),
      wt AS (SELECT cluster_name, ingest_seq, t, n, tf * idf AS w FROM tf JOIN idf USING (cluster_name, t)),
      nm AS (SELECT cluster_name, ingest_seq, sqrt(sum(w * w)) AS norm FROM wt GROUP BY ALL),
      un AS (SELECT cluster_name, ingest_seq, t, n, w / norm AS u FROM wt JOIN nm USING (cluster_name, ingest_seq)),
      ce AS (SELECT cluster_name, t, sum(u) / any_value(n) AS c FROM un GROUP BY ALL),
      sc AS (SELECT cluster_name, ingest_seq, round(sum(u * c), 9) AS score FROM un JOIN ce USING (cluster_name, t) GROUP BY ALL),
      rw AS (SELECT e.cluster_name, e.ingest_seq, lower(subject) AS s, coalesce(score, 0.0) AS score FROM e LEFT JOIN sc USING (cluster_name, ingest_seq)),
      be AS (SELECT * FROM rw QUALIFY row_number() OVER (PARTITION BY cluster_name, s ORDER BY score DESC, ingest_seq) = 1)
      SELECT cluster_name, ingest_seq, CAST(row_number() OVER (PARTITION BY cluster_name ORDER BY score DESC, ingest_seq) AS INT) AS rank FROM be QUALIFY rank <= 3"""


def _named_clusters() -> str:
    hits = ", ".join(f"{{'s': {' + '.join(f'CAST(max(contains(lower(text), {q(w.lower())})) AS INT)' for w in ws_)}, 'o': {-i}, 'name': {q(n)}}}" for i, (n, ws_) in enumerate(TOPICS.items()))
    start = MAIL + ", x AS (SELECT cluster_name, subject_normalized || ' ' || clean_body AS text FROM mail)" + _top_terms("x", 1)
    return start + f", h AS (SELECT cluster_name, list_max([{hits}]) AS b FROM x GROUP BY 1) SELECT h.cluster_name, CASE WHEN b.s > 0 THEN b.name ELSE coalesce(term, 'נושא_' || h.cluster_name) END AS name FROM h LEFT JOIN tt USING (cluster_name)"


def _rules() -> str:
    """Texts, rules as rows, scores by joining them."""
    words = ", ".join(f"({i}, {q(r.name)}, {r.priority}, {j}, {q(w)}, {q(C._clean(w))})" for i, r in enumerate(C.RULES) for j, w in enumerate(r.keywords))
    subs = ", ".join(f"({i}, {j}, {q(n)}, {q(C._clean(w))})" for i, r in enumerate(C.RULES) for j, (n, ws_) in enumerate(r.subtopics) for w in ws_)
    outs = ", ".join(f"({i}, {q(C._clean(w))})" for i, r in enumerate(C.RULES) for w in r.excluded)
    return MAIL + f""", x0 AS (
        SELECT *, {search_text(subject('subject'))} AS xs, {search_text("coalesce(nullif(clean_body, ''), body)")} AS xb, {search_text('folder_path')} AS xf, {search_text('from_email')} AS xn FROM mail),
      x AS (SELECT *, array_to_string(list_filter([xs, substr(xb, 1, 6000), xf, xn], lambda p: p <> ''), ' ') AS xa FROM x0),
      w(ord, name, priority, j, kw, k) AS (VALUES {words}),
      u(ord, j, sub, k) AS (VALUES {subs}),
      e(ord, k) AS (VALUES {outs}),
      p AS (SELECT ingest_seq, ord, name, priority, j, kw, CASE WHEN contains(xs, k) THEN 7.0 + CASE WHEN contains(k, ' ') THEN 1.0 ELSE 0.0 END ELSE 0.0 END + CASE WHEN contains(xf, k) THEN 4.5 ELSE 0.0 END
              + CASE WHEN contains(xb, k) THEN 2.5 ELSE 0.0 END + CASE WHEN contains(xa, k) THEN 0.5 ELSE 0.0 END AS s FROM x CROSS JOIN w),
      m AS (SELECT ingest_seq, ord, any_value(name) AS name, any_value(priority) AS priority, any_value(priority) + sum(s) AS s, coalesce(string_agg(kw, ';' ORDER BY j) FILTER (s > 0), '') AS matched FROM p GROUP BY ingest_seq, ord),
      n AS (SELECT ingest_seq, ord, count(*) AS n FROM x JOIN e ON contains(xa, e.k) GROUP BY ALL),
      t0 AS (SELECT ingest_seq, ord, j, any_value(sub) AS sub, sum(CASE WHEN contains(xs, k) THEN 5.0 ELSE 0.0 END + CASE WHEN contains(xf, k) THEN 2.0 ELSE 0.0 END + CASE WHEN contains(xb, k) THEN 1.5 ELSE 0.0 END) AS s FROM x CROSS JOIN u GROUP BY ingest_seq, ord, j),
      t AS (SELECT ingest_seq, ord, arg_max(sub, s * 1000 - j) AS sub, max(s) AS s FROM t0 GROUP BY ingest_seq, ord),
      sc AS (SELECT m.ingest_seq, m.ord, m.name, m.priority, CAST(m.s - 4.0 * coalesce(n.n, 0) AS DOUBLE) AS score, m.matched, CASE WHEN t.s > 0 THEN t.sub ELSE '' END AS subtopic FROM m LEFT JOIN n USING (ingest_seq, ord) LEFT JOIN t USING (ingest_seq, ord)),
      noise AS (SELECT ingest_seq, list_bool_or(list_transform([{', '.join(map(q, A.SYSTEM_WORDS))}], lambda w: contains(concat_ws(' ', xs, substr(xb, 1, 400), xf, xn), w))) AS is_noise FROM x),
      best AS (SELECT ingest_seq, arg_max(name, score * 1000000 + priority * 1000 - ord) AS name, max(score) AS score, arg_max(matched, score * 1000000 + priority * 1000 - ord) AS matched, arg_max(subtopic, score * 1000000 + priority * 1000 - ord) AS subtopic FROM sc GROUP BY ingest_seq),
      cl AS (SELECT x.*, CASE WHEN is_noise THEN {q(C.NOISE)} WHEN best.score < 4.0 THEN {q(C.MANUAL)} ELSE best.name END AS knowledge_topic,
               CASE WHEN is_noise THEN 0.0 WHEN best.score < 4.0 THEN greatest(best.score, 0.0) ELSE best.score END AS knowledge_score, NOT is_noise AND best.score < 4.0 AS knowledge_review_required, is_noise AS is_system_noise,
               CASE WHEN is_noise THEN {q(C.NOISE_SUB)} ELSE coalesce(CASE WHEN best.score >= 4.0 THEN nullif(best.subtopic, '') END, nullif({strip('llm_subtopic')}, ''), {_fallback_subtopic()}) END AS knowledge_subtopic,
               CASE WHEN is_noise THEN '' ELSE replace(best.matched, ';', '; ') END AS knowledge_matched_terms, coalesce(nullif(clean_body, ''), body) AS body_for_pack
             FROM x JOIN noise USING (ingest_seq) JOIN best USING (ingest_seq))
    """


def flag_columns(low: str) -> str:
    """The flags of the text ``low`` and the topic and kind of sender, as columns."""
    kind = f"CASE WHEN lower(substr(from_email, instr(from_email, '@') + 1)) = 'kedembenefit.example' THEN 'internal_staff' ELSE {_ordered_case(low, A.SENDER_TYPES, q('unknown'))} END"
    told = {"complaint": word(low, A.COMPLAINT), "request": word(low, A.REQUEST), "urgent": word(low, A.URGENT), "question": f"(contains({low}, '?') OR contains({low}, '؟') OR {word(low, A.QUESTION)})", "sender_type": kind, "topic": _ordered_case(low, TOPICS, q("unknown"))}
    return ", ".join(f"{e} AS {n}" for n, e in told.items())


def language(c: str) -> str:
    s = f"substr({c}, 1, 4000)"
    return f"CASE WHEN {matching(s, '[א-ת]')} > {matching(s, '[a-zA-Z]')} AND {matching(s, '[א-ת]')} > 5 THEN 'he' WHEN {matching(s, '[a-zA-Z]')} > 5 THEN 'en' END"


def clean_from(table: str, key: str) -> str:
    """A query that begins with ``cleaned``: key, text, mostly_quoted, notes."""
    return "WITH cleaned AS (" + _clean().replace("FROM messages", f"FROM {table}").replace("ingest_seq", key) + ")"


def _clean() -> str:
    """The cleaner over lists of lines."""
    line = lambda x: strip(x)
    reply, sign = (p.replace("(?iu)", "(?i)") for p in (REPLY_LINES, SIGNATURE_LINES))
    return f"""
    WITH s AS (SELECT ingest_seq, {ws("coalesce(body_text_raw, '')")} AS src FROM messages),
    l AS (SELECT *, string_split(src, chr(10)) AS lines FROM s),
    c AS (SELECT *, list_position(list_transform(lines, lambda x, i: i > 1 AND regexp_matches({line('x')}, {q(reply)})), true) AS cut,
            len(list_filter(lines, lambda x: regexp_matches(x, {q(QUOTED_LINE)}))) / len(lines) >= 0.6 AS quoted FROM l),
    k AS (SELECT *, list_filter(CASE WHEN cut > 0 THEN lines[:cut - 1] ELSE lines END, lambda x: NOT regexp_matches(x, {q(QUOTED_LINE)})) AS kept FROM c),
    g AS (SELECT *, list_max(list_filter(list_transform(kept, lambda x, i: CASE WHEN i > len(kept) - 12 AND regexp_matches({line('x')}, {q(sign)}) THEN i END), lambda i: i IS NOT NULL)) AS sig FROM k),
    t AS (SELECT *, {ws("array_to_string(CASE WHEN sig IS NULL THEN kept ELSE kept[:sig - 1] END, chr(10))")} AS text FROM g)
    SELECT ingest_seq, CASE WHEN src = '' THEN '' ELSE text END AS text, CASE WHEN src = '' THEN false ELSE quoted OR length(text) < greatest(80.0, length(src) * 0.25) END AS mostly_quoted,
      CASE WHEN src = '' THEN 'empty_body' ELSE array_to_string(list_filter([CASE WHEN cut > 0 THEN 'reply_history_removed' END, CASE WHEN sig IS NOT NULL THEN 'signature_removed' END], lambda n: n IS NOT NULL), ';') END AS notes
    FROM t"""


_KEEP = "lower(is_filtered) <> 'true' AND NOT is_system_noise AND knowledge_topic <> ''"


def statements() -> dict[str, str]:
    one = lambda t, key, e: f"SELECT {key}, {e} AS value FROM {t}"
    m = lambda e: MAIL + one("mail", "ingest_seq", e)
    html = "'<html><head><title>t</title></head><body><div>Hello<br>' || coalesce(text, '') || '</div><style>p{}</style><p>End &amp; <b>out</b></p></body></html>'"
    # RE2 has no back references: one replacement for each element.
    for tag in ("script", "style", "head"):
        html = rx(html, rf"(?is)<{tag}\b.*?</{tag}\s*>")
    html = rx(rx(html, r"(?is)<!--.*?-->|<meta\b[^>]*>"), r"(?i)<br\s*/?>", "'<br>' || chr(10) || '<br>'")
    html = rx(rx(html, r"(?i)</(p|div|tr|li)\s*>", r"chr(10) || '</\1>'"), r"(?:</?[A-Za-z!][^>]*>)+", "chr(10)")
    for entity, char in ENTITIES:
        html = f"replace({html}, {q(entity)}, {q(char)})"
    name = strip("coalesce(nullif('a/b: ' || original_filename, ''), 'file')")
    name = rx(rx(rx(rx(name, r'[<>:"/\\|?*\x{00}-\x{1f}]', "'_'"), "_+", "'_'"), f"[{WS}]+", "' '"), r"\A[ .]+|[ .]+\z")
    visible = rx("substr(body, 1, 4000)", rf"[{WS}\pC\pZ]")
    marks = " + ".join(count_of("substr(body, 1, 4000)", k) for k in A.MOJIBAKE)
    corrupt = f"coalesce(contains(substr(body, 1, 4000), chr(65533)) OR ({marks}) >= 10 OR ({marks}) / greatest(length({visible}), 1) > 0.03, false)"
    words = lambda c: f"CASE WHEN {strip(c)} = '' THEN 0 ELSE len(regexp_split_to_array({strip(c)}, {q(f'[{WS}]+')})) END"
    domain = lambda c: "(" + " OR ".join(f"contains({c}, {q(t)})" for t in A.DOMAIN_TERMS) + ")"
    reason = f"CASE WHEN {strip('body')} = '' THEN 'empty_body' WHEN {corrupt} THEN 'encoding_corrupt' WHEN regexp_matches(lower(subject), {q(A.AUTO_REPLY)}) THEN 'auto_reply' WHEN regexp_matches(lower(from_email), {q(A.NOISE_SENDER)}) THEN 'noise_sender' WHEN ({words('body')}) < 30 AND NOT {domain(chr(98) + 'ody || ' + q(' ') + ' || subject')} THEN 'too_short' ELSE '' END"
    low = "lower(subject || chr(10) || clean_body)"
    fl = {"complaint": word(low, A.COMPLAINT), "request": word(low, A.REQUEST), "urgent": word(low, A.URGENT), "question": f"(contains({low}, '?') OR contains({low}, '؟') OR {word(low, A.QUESTION)})"}
    script = "substr(text, 1, 4000)"
    control = r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}-\x{9f}]"
    unprintable = r"[\p{Cc}\p{Cf}\p{Co}\p{Cs}\p{Zl}\p{Zp}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
    damage = " + ".join(count_of("body", k) for k in ("×", "Ã", "Â", "׳", "ֲ", "ג€", "ן¿½"))
    breaks = r"[\r\n\t]"
    score = f"(length(body) - {matching(rx('body', breaks), unprintable)}) / length(body) * 20.0 + {matching('body', '[א-ת]')} * 3 + {matching('body', '[a-zA-Z]')} * 0.25 - ({count_of('body', chr(0xFFFD))} + {count_of('body', '?')}) * 50 - ({damage}) * 30 - {matching('body', control)} * 15"
    key = lambda n, c: f"'{n}:' || substr({stable(jpart(c))}, 1, 24)"
    some = lambda c: f"coalesce({c}, '') <> ''"
    native = f"CASE WHEN {some('conversation_id')} THEN {key('native', 'conversation_id')} WHEN {some('reference_ids[1]')} THEN {key('refs', 'reference_ids[1]')} WHEN {some('in_reply_to')} THEN {key('reply', 'in_reply_to')} END"
    synthetic = f"'synthetic:' || substr({stable(jpart(chr(99) + 'oalesce(subject_normalized, ' + q('') + ')'), _WHO_JSON, jpart(_WEEK.format(_AT)))}, 1, 24)"
    rec = stable(*(jpart(c) for c in ("source_pst", "source_folder", "message_id", iso("sent_at", " "), "sender_email", "coalesce(subject_normalized, '')", "content_hash")))
    people = "list_filter(list_concat([sender_email], coalesce(to_emails, []), coalesce(cc_emails, []), coalesce(bcc_emails, [])), lambda x: x IS NOT NULL AND x <> '')"
    out = {
        "normalize_whitespace": one("messages", "ingest_seq", ws("body_text_raw")),
        "normalize_subject": one("messages", "ingest_seq", subject("subject_raw")),
        "normalize_email": one("raw_messages", "raw_id", f"nullif(lower({rx(strip(q(' <') + ' || upper(sender_email) || ' + q('> ')), r'^[<>]+|[<>]+$')}), '')"),
        "reply_forward": one("messages", "ingest_seq", f"CASE WHEN regexp_matches({strip('lower(subject_raw)')}, {q(rf'^(?:fw|fwd|הועבר|העברה)[{WS}]*[:：]')}) THEN 'forward' WHEN regexp_matches({strip('lower(subject_raw)')}, {q(rf'^(?:re|תגובה|השב)[{WS}]*[:：]')}) THEN 'reply' END"),
        "html_to_text": one("documents", "doc_id", ws(html)),
        "clean_body": _clean(),
        "word_count": one("documents", "doc_id", f"CAST({words('coalesce(text, ' + q('') + ')')} AS BIGINT)"),
        "strip_control": one("documents", "doc_id", rx("text", r"[\x{00}-\x{08}\x{0b}-\x{1f}]")),
        "normalize_search_text": one("messages", "ingest_seq", search_text("body_text_raw")),
        "subject_snippet": one("messages", "ingest_seq", f"coalesce(nullif(substr({ws(subject('subject_raw'))}, 1, 120), ''), {q(NO_TITLE)})"),
        "embedding_text": m(ws("subject || chr(10) || subject || chr(10) || substr(body, 1, 3500)")),
        "tokens": m(r"array_to_string(regexp_extract_all(lower(body), '[\x{590}-\x{5ff}A-Za-z0-9][\x{590}-\x{5ff}A-Za-z0-9_-]+'), ' ')"),
        "sanitize_filename": f"SELECT attachment_id, record_id, {name} AS value FROM attachments",
        "truncate_body": one("documents", "doc_id", f"CASE WHEN length(text) > 500 THEN {rx('substr(text, 1, 500)', f'[{WS}]+$')} || chr(10) || '[truncated]' ELSE text END"),
        "split_header": one("emails_raw", "row_id", f"array_to_string(list_filter(list_transform(string_split(replace(to_emails, ';', ','), ','), lambda x: {strip('x')}), lambda x: x <> ''), '|')"),
        "clean_header_id": one("raw_messages", "raw_id", f"nullif({rx(strip('message_id'), '^[<>]+|[<>]+$')}, '')"),
        "as_float": f"SELECT row_id, try_cast({strip('word_count')} AS DOUBLE) AS value, try_cast({strip('nested_depth')} AS DOUBLE) AS depth FROM emails_raw",
        "text_quality": one("emails_raw", "row_id", f"CASE WHEN length(body) = 0 THEN -1000000.0 ELSE round({score}, 6) END"),
        "content_hash": m(f"sha256(lower(subject_normalized || chr(10) || {strip('clean_body')}))"),
        "record_id": one("messages", "ingest_seq", f"substr({rec}, 1, 24)"),
        "week_bucket": one("messages", "ingest_seq", f"CASE WHEN sent_at IS NOT NULL THEN {_WEEK.format('sent_at')} END"),
        "format_date": one("messages", "ingest_seq", date_text("sent_at")),
        "participants_key": one("messages", "ingest_seq", f"array_to_string({_WHO}, ';')"),
        "recipient_emails": one("raw_messages", "raw_id", f"array_to_string(list_filter(list_transform(to_recipients, lambda r: nullif(lower({rx(strip('r.email'), '^[<>]+|[<>]+$')}), '')), lambda x: x IS NOT NULL), ';')"),
        "parent_message_id": one("messages", "ingest_seq", "coalesce(nullif(in_reply_to, ''), reference_ids[-1])"),
        "first_header": one("messages", "ingest_seq", "coalesce(nullif(list_filter(map_entries(internet_headers), lambda e: lower(e.key) = 'importance')[1].value, ''), nullif(list_filter(map_entries(internet_headers), lambda e: lower(e.key) = 'x-priority')[1].value, ''))"),
        "folder_filter": "SELECT ingest_seq, source_folder FROM messages WHERE contains(lower(source_folder), 'inbox/claims')",
        "parse_llm_json": f"SELECT doc_id, coalesce(nullif({strip('source')}, ''), 'unknown') AS topic, 's' AS subtopic, array_to_string(list_filter(['a', lang], lambda x: {strip('x')} <> ''), ';') AS tags, CAST(n_chars AS DOUBLE) AS confidence FROM documents",
        "keyword_flags": MAIL + f", f AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in fl.items())} FROM mail) SELECT ingest_seq, complaint, request, urgent, question, CASE WHEN complaint THEN 'complaint' WHEN urgent AND request THEN 'urgent_request' WHEN request THEN 'request' WHEN question THEN 'question' ELSE 'unknown' END AS intent, CASE WHEN lower(substr(from_email, instr(from_email, '@') + 1)) = 'kedembenefit.example' THEN 'internal_staff' ELSE {_ordered_case(low, A.SENDER_TYPES, q('unknown'))} END AS sender_type, {_ordered_case(low, TOPICS, q('unknown'))} AS topic FROM f",
        "encoding_corrupt": one("emails_raw", "row_id", corrupt),
        "contains_domain_term": m(domain("body || ' ' || subject")),
        "filter_reason": one("emails_raw", "row_id", reason),
        "filter_reason_counts": f"SELECT {reason} AS value, count(*) AS n FROM emails_raw GROUP BY 1",
        "detect_language": one("documents", "doc_id", f"CASE WHEN {matching(script, '[א-ת]')} > {matching(script, '[a-zA-Z]')} AND {matching(script, '[א-ת]')} > 5 THEN 'he' WHEN {matching(script, '[a-zA-Z]')} > 5 THEN 'en' END"),
        "domain_name": m(_best_topic("", "lower(subject || ' ' || body)", "NULL", False)),
        "legacy_topic": m(_best_topic("lower(subject)", "lower(concat_ws(chr(10), subject, clean_body, folder_path))", "cluster_name", True)),
        "dedup_mark": KEYS + ", f AS (SELECT *, first_value(ingest_seq) OVER w AS fs, first_value(record_id) OVER w AS fr FROM k WINDOW w AS (PARTITION BY dedup_key ORDER BY order_date, record_id NULLS FIRST, ingest_seq)) SELECT ingest_seq, record_id, fs <> ingest_seq AS is_duplicate, CASE WHEN fs <> ingest_seq THEN fr END AS duplicate_of FROM f",
        "group_duplicates": KEYS + ", f AS (SELECT *, first_value(record_id) OVER (PARTITION BY dedup_key ORDER BY order_date, record_id NULLS FIRST, ingest_seq) AS fr FROM k) SELECT ingest_seq, fr AS canonical, count(*) OVER (PARTITION BY fr) AS members FROM f",
        "thread_keys": f"SELECT ingest_seq, coalesce({native}, {synthetic}) AS built_thread_key, {synthetic} AS synthetic_key FROM messages",
        "thread_position": KEYS + "SELECT ingest_seq, thread_key, CAST(row_number() OVER (PARTITION BY thread_key ORDER BY order_date, record_id NULLS FIRST, ingest_seq) AS INT) AS position FROM k",
        "thread_summary": KEYS + f"SELECT thread_key, count(*) AS message_count, min({_AT}) AS first_message_at, max({_AT}) AS last_message_at, first(coalesce(subject_normalized, '') ORDER BY order_date, record_id NULLS FIRST, ingest_seq) AS subject_normalized, array_to_string(list_sort(list_distinct(flatten(list({people})))), ';') AS participants, CAST(sum(CAST(coalesce(is_duplicate, false) AS INT)) AS BIGINT) AS duplicate_count, bool_or(has_attachments) AS has_attachments, string_agg(DISTINCT source_pst, ';' ORDER BY source_pst) AS source_psts FROM k GROUP BY thread_key",
        "recipients_bridge": " UNION ALL ".join(f"SELECT ingest_seq, record_id, '{k}' AS recipient_type, unnest({k}_emails) AS email FROM messages" for k in ("to", "cc", "bcc")),
        "message_attachments": "WITH s AS (SELECT record_id, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes, bool_or(is_inline) AS any_inline FROM attachments GROUP BY record_id) SELECT ingest_seq, record_id, coalesce(files, 0) AS files, bytes, any_inline FROM messages LEFT JOIN s USING (record_id)",
        "parent_child": "WITH o AS (SELECT message_id, min(raw_id) AS parent_raw_id FROM raw_messages WHERE message_id IS NOT NULL GROUP BY message_id) SELECT raw_id, parent_raw_id, parent_raw_id IS NULL AS orphan FROM raw_messages r LEFT JOIN o ON r.parent_record_message_id = o.message_id WHERE r.parent_record_message_id IS NOT NULL",
        "cluster_name_join": "SELECT ingest_seq, source_pst, coalesce(tz, '') AS name FROM messages LEFT JOIN mailboxes USING (source_pst)",
        "mock_tag": "SELECT doc_id, coalesce('tag-' || max_repeats, d.source, '') AS llm_topic FROM documents d LEFT JOIN mix_targets USING (source)",
        "summarize_topics": MAIL + _summary("cluster_name", "from_email", 5, "topic", "top_people"),
        "summarize_people": MAIL + _summary("from_email", "cluster_name", 5, "person", "top_topics"),
        "value_counts": "SELECT coalesce(nullif(language, ''), 'unknown') AS value, count(*) AS n FROM messages GROUP BY 1",
        "processing_report": "SELECT count(*) AS messages, count_if(is_duplicate) AS duplicates, count(DISTINCT thread_key) AS threads, count_if(has_attachments) AS with_attachments, count_if(coalesce(body_text_clean, '') <> '') AS with_clean_body FROM messages",
        "extract_stats": f"SELECT count(*) AS emails, count(DISTINCT folder_path) AS folders, round(count_if({strip('body')} <> '') / greatest(count(*), 1) * 100, 6) AS percent_with_body, count(DISTINCT from_email) AS senders FROM emails_raw",
        "top_senders": "SELECT from_email, count(*) AS n FROM emails_raw GROUP BY 1 ORDER BY n DESC, from_email LIMIT 10",
        "cluster_stats": MAIL + "SELECT cluster_name, count(*) AS emails, count_if(is_filtered = 'True') AS filtered, count(DISTINCT from_email) AS senders FROM mail GROUP BY 1",
        "date_range": MAIL + f"SELECT folder_path, {date_text('min(date_sort)')} AS first_date, {date_text('max(date_sort)')} AS last_date FROM mail GROUP BY 1",
        "top_terms": _embedded() + _top_terms("e", 5) + " SELECT cluster_name, term, n, rank FROM tt",
        "representatives": _representatives(),
        "name_clusters": _named_clusters(),
        "row_topic": MAIL + f"SELECT ingest_seq, coalesce(nullif({strip('llm_topic')}, ''), nullif({strip('cluster_name')}, ''), '') AS topic FROM mail",
        "search_topic": _search(topic="Inbox", limit=50),
        "search_person": _search(person="dana.morvane"),
        "search_query": _search(query="tax certificate"),
        "search_ranked": _search("claims", "kedembenefit", "salary slip", 20),
        "system_noise_rules": _rules() + "SELECT ingest_seq, is_noise AS value FROM noise",
        "rule_scores": _rules() + "SELECT ingest_seq, name AS rule, score, matched, subtopic FROM sc",
        "classify_rules": _rules() + "SELECT ingest_seq, knowledge_topic, CAST(knowledge_score AS DOUBLE) AS knowledge_score, knowledge_review_required, is_system_noise FROM cl",
        "classify_cluster": _rules() + f"SELECT ingest_seq, CASE WHEN is_system_noise THEN {q(C.NOISE)} ELSE coalesce(nullif({ws('cluster_name')}, ''), {q(C.MANUAL)}) END AS knowledge_topic, CASE WHEN is_system_noise THEN 'rules' ELSE 'cluster' END AS knowledge_mode FROM cl",
        "classify_llm": _rules() + f"SELECT ingest_seq, CASE WHEN is_system_noise THEN {q(C.NOISE)} ELSE coalesce(nullif({ws('cluster_name')}, ''), {q(C.MANUAL)}) END AS knowledge_topic, CASE WHEN is_system_noise THEN 'rules' ELSE 'llm' END AS knowledge_mode FROM cl",
        "classify_hybrid": _rules() + "SELECT ingest_seq, CASE WHEN NOT is_system_noise AND ingest_seq % 3 = 0 AND ingest_seq % 10 / 10 >= 0.75 THEN 'tagged' ELSE knowledge_topic END AS knowledge_topic, CASE WHEN NOT is_system_noise AND ingest_seq % 3 = 0 AND ingest_seq % 10 / 10 >= 0.75 THEN 'llm' ELSE 'rules' END AS knowledge_mode FROM cl",
        "pack_included": _rules() + f"SELECT ingest_seq FROM cl WHERE {_KEEP}",
        "pack_excluded": _rules() + f"SELECT ingest_seq FROM cl WHERE NOT ({_KEEP})",
        "pack_people": _rules() + f", kept AS (SELECT * FROM cl WHERE {_KEEP})" + _summary("from_email", "knowledge_topic", 6, "person", "top_topics", "kept") + " ORDER BY email_count DESC, person LIMIT 60",
        "review_queue": _rules() + ", v AS (SELECT *, array_to_string(list_filter([CASE WHEN knowledge_review_required THEN 'manual_review' END, CASE WHEN knowledge_score < 4.0 THEN 'low_score' END, " + f"CASE WHEN {strip('subject')} = '' THEN 'missing_subject' END, CASE WHEN length(coalesce(nullif(clean_body, ''), body)) < 180 THEN 'short_body' END], lambda z: z IS NOT NULL), '; ') AS review_reason FROM cl) SELECT ingest_seq, review_reason, knowledge_topic, CAST(knowledge_score AS DOUBLE) AS knowledge_score, message_id, from_email, subject FROM v WHERE review_reason <> ''",
        "render_email": _rules() + _rendered() + " SELECT ingest_seq, text FROM r",
        "greedy_pack": _packs() + "SELECT knowledge_topic, ingest_seq, part, place, chars FROM packed",
        "manifest": _packs() + f", mf AS (SELECT full_rows.*, printf('sources/%s__part_%03d.docx', slug, part) AS source_file FROM full_rows JOIN slugs USING (knowledge_topic)) SELECT source_file, source_file || printf(' / EMAIL %04d', place) AS source_locator, knowledge_topic, knowledge_subtopic, CAST(knowledge_score AS DOUBLE) AS knowledge_score, 'rules' AS knowledge_mode, knowledge_review_required, message_id, {date_text('date_sort')} AS date, from_email, subject, folder_path, parent_record_message_id, nested_depth, container_attachment_filename, cluster_name, llm_topic, CAST(NULL AS DOUBLE) AS llm_confidence, knowledge_matched_terms, ingest_seq FROM mf",
        "pack_topics": _packs() + f"SELECT f.knowledge_topic, count(*) AS email_count, max(part) AS source_file_count, {date_text('min(date_sort)')} AS first_date, {date_text('max(date_sort)')} AS last_date, any_value(top_people) AS top_people, any_value(top_subtopics) AS top_subtopics FROM full_rows f LEFT JOIN {_tops('knowledge_topic', 'from_email', 8, 'top_people', 'from_email <> ' + q(''))} p USING (knowledge_topic) LEFT JOIN " + _tops("knowledge_topic", "knowledge_subtopic", 5, "top_subtopics", shown="knowledge_subtopic || ' (' || n || ')'") + " u USING (knowledge_topic) GROUP BY 1",
        "part_header": _packs() + f"SELECT f.knowledge_topic, f.part, count(*) AS email_count, {date_text('min(date_sort)')} AS first_date, {date_text('max(date_sort)')} AS last_date, any_value(top_people) AS top_people, any_value(total_parts) AS total_parts FROM full_rows f JOIN (SELECT knowledge_topic, max(part) AS total_parts FROM packed GROUP BY 1) USING (knowledge_topic) LEFT JOIN {_tops('knowledge_topic, part', 'from_email', 8, 'top_people', 'from_email <> ' + q(''))} p USING (knowledge_topic, part) GROUP BY 1, 2",
        "pack_totals": _packs() + "SELECT count(*) AS emails, count(DISTINCT (knowledge_topic, part)) AS files FROM packed",
        "distinct_vectors": "SELECT count(DISTINCT list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 8))) AS vectors FROM embeddings",
    }
    return out
