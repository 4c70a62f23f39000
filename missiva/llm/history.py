"""Problem 1: what the sender of an e-mail newly wrote.

Three kinds of lines go: history (quoted or forwarded, with the lines that introduce it),
notices added by systems, and the signature. History is found by a generalised suffix automaton
over the words of each thread, which marks long runs inherited from earlier messages however the
lines are wrapped (in threads too long for one automaton by joined hashes of runs, with the same
result), and by the layout of quotations, since the quoted originals are often not in
the archive. What remains of the end of each stretch is compared with the forms endings take and
with the endings the sender uses again and again.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from missiva.session import cut

#: Shortest inherited run, in words.
INHERITED_WORDS = 30
#: Messages of a thread that goes through an automaton, at most; in longer ones runs are looked up by their hashes.
THREAD_WINDOW = 400
#: A line is an ending of its sender when it stands among the last ENDING_LINES lines of new text in so many of the sender's distinct bodies and in this share of them.
ENDING_BODIES, ENDING_SHARE, ENDING_LINES = 3, 0.1, 9
#: Parts into which the rows of one sender are split where endings are joined.
SALTS = 16

# ---- forms of quotations. Words that introduce them, in several languages.
_DATE = r"(?:\d{1,4}[./-]\d{1,2}[./-]\d{1,4}|\d{1,2}\.? [^\W\d]{3,10}\.?,? \d{4}|[^\W\d]{3,10}\.? \d{1,2}(?:st|nd|rd|th)?,? \d{4})"
_INTRO = re.compile(
    r"^[\s>|*]*(?:"
    rf"(?:On|At)\b.{{0,40}}{_DATE}.{{0,160}}\bwrote\s*:?|"
    rf"In reply to\b.{{1,80}}{_DATE}.{{0,30}}|"
    r".{1,100}<[^<>]*@[^<>]*>\s*(?:writes|wrote|schrieb|escribió|escreveu|a écrit|пишет|написал(?:а|\(а\))?|כתב/?ה?)\s*:|"
    rf".{{1,60}}\bwrote on\b.{{0,30}}{_DATE}.{{0,40}}:|"
    rf"Le\b.{{0,30}}{_DATE}.{{0,160}}\ba écrit\s*:|"
    rf"Am\b.{{0,30}}{_DATE}.{{0,160}}\bschrieb\b.{{0,120}}:|"
    rf"El\b.{{0,30}}{_DATE}.{{0,160}}\bescribió\s*:|"
    rf"Em\b.{{0,30}}{_DATE}.{{0,160}}\bescreveu\s*:|"
    rf".{{0,40}}{_DATE}.{{0,160}}(?:пишет|написал(?:а|\(а\))?|كتب|كتبت)\s*:|"
    rf"(?:في|بتاريخ|يوم)\b.{{0,40}}{_DATE}.{{0,160}}:|"
    rf"ב-?\s?{_DATE}.{{0,30}}מאת.{{0,120}}:|"
    rf"בתאריך\b.{{0,20}}{_DATE}.{{0,160}}(?:כתב|כתבה|כתב/ה|מאת)\b.{{0,100}}:|"
    rf".{{1,60}}(?:כתב|כתבה|כתב/ה) (?:בתאריך|ב-?)\s?.{{0,20}}{_DATE}.{{0,20}}:"
    r")\s*$",
    re.I,
)
_HINT = re.compile(r"\d[./-]\d|\b(?:19|20)\d\d\b|@|<$")
_BEGIN = re.compile(
    r"^[\s>|*]*(?:-{2,}\s*(?:Original|Forwarded|Ursprüngliche|Weitergeleitete|Message|Mensaje|Mensagem|Исходное|Пересылаемое|Пересланное|הודעה|הועבר|رسالة)\b[^-]{0,40}-{2,}|"
    r"Begin forwarded message\s*:|Start of forwarded message|Forwarded by .{3,60} on \d.*|"
    r"Début du message (?:transféré|réexpédié)\s*:|Anfang der weitergeleiteten (?:Nachricht|E-Mail)\s*:|Inicio del mensaje reenviado\s*:|Início da mensagem (?:reencaminhada|encaminhada)\s*:|"
    r"Начало (?:пересылаемого|переадресованного) (?:письма|сообщения)\s*:|תחילת הודעה שהועברה\s*:|بداية الرسالة .{0,20}:)\s*$",
    re.I,
)
_HEADS = {
    "from": "From|De|Von|Da|От|От кого|מאת|من",
    "date": "Sent|Date|Envoyé|Gesendet|Datum|Enviado|Enviada|Enviado el|Fecha|Data|Дата|Отправлено|נשלח|תאריך|التاريخ|تاريخ|أرسلت|تم الإرسال",
    "to": "To|À|A|An|Para|Кому|אל|إلى",
    "cc": "Cc|Bcc|Kopie|Копия|עותק|نسخة",
    "subject": "Subject|Objet|Betreff|Asunto|Assunto|Тема|נושא|הנדון|الموضوع",
}
_HEAD = re.compile(r"^[\s>|]*\**(?:" + "|".join(f"(?P<{k}>{v})" for k, v in _HEADS.items()) + r")\s?:\**\s*(?P<value>\S.*)?$", re.I)
_RULE = re.compile(r"^[\s>|]*[_=*-]{8,}\s*$")
_MARK = re.compile(r"^\s*(?:>|\|(?=\s*[^|]*$))")
_MARKS = re.compile(r"^\s*(?:[>|]\s?)+")

# ---- notices of systems. How they begin.
_NOTICE = re.compile(
    r"^\W*(?:\[(?:חיצוני|externe?|extern|externo|внешн\w+|خارجي)\b|Privileged (?:&|and) confidential|Confidential(?:ity)?\b.{0,20}(?::|-|and)|חסוי|סודי|EXTERNAL(?: SENDER| E-?MAIL)?\b|CAUTION\s*[:!]|WARNING\s*: (?:this|external)|זהירות\s*:|אזהרה\s*:|ATTENTION\s*: ce (?:message|courriel)|"
    r"This (?:e-?mail|message|communication|transmission)(?: and any| \(including| is (?:intended|confidential|private)| may contain| contains (?:confidential|privileged))|"
    r"CONFIDENTIALITY NOTICE|DISCLAIMER\b|Legal notice\s*:|NOTICE\s*:|The (?:information|contents?) (?:contained )?(?:in|of) this (?:e-?mail|message)|"
    r"Please (?:think of|consider) the (?:trees|environment)|Think (?:of the trees|before you print)|Save (?:paper|a tree)|"
    r"Nothing in this (?:e-?mail|message) (?:is|shall|constitutes)|If you (?:are not|received this|have received this) .{0,60}(?:recipient|in error|by mistake)|"
    r"The company accepts no liability|(?:Scanned|Checked) (?:by|for viruses)|Ce (?:message|courriel) (?:et|est)|Avant d'imprimer|Pensez à l'environnement|"
    r"Diese (?:E-?Mail|Nachricht) (?:enthält|ist|kann)|Bitte (?:denken|prüfen) Sie .{0,40}(?:Umwelt|drucken)|Este (?:mensaje|correo|mensagem|e-mail) (?:y|e|es|é|contiene|contém|puede)|Antes de imprimir|"
    r"Это (?:сообщение|письмо) (?:и|может|содержит|предназначено)|Настоящее (?:сообщение|письмо)|Перед печатью|"
    r"המידע ב(?:מסמך|הודעה|דואר)|הודעה זו (?:ו|מיועדת|עשויה|מכילה|התקבלה)|דוא\"ל זה|לפני ה?הדפס|אין באמור|הודעת סודיות|"
    r"هذه الرسالة (?:و|سرية|قد)|قبل الطباعة)",
    re.I,
)
_DEVICE = re.compile(
    r"^\W*(?:Sent from (?:my|the|a|Mail|Outlook|Yahoo)\b.{0,40}|Get (?:the )?(?:mail app|Outlook)\b.{0,40}|Sent via .{1,30}|Envoyé de mon .{1,30}|Von meinem .{1,30}gesendet|Enviado desde mi .{1,30}|Enviado do meu .{1,30}|"
    r"Отправлено с .{1,30}|נשלח מ(?:ה|ן ה)?(?:נייד|טלפון|אייפון|iPhone|מכשיר).{0,60}|أرسلت من .{1,30}|مرسل من .{1,30})\W*$",
    re.I,
)
# ---- signatures. Words of farewell.
_FAREWELL = re.compile(
    r"^\W*(?:(?:with )?(?:(?:kind(?:est)?|best|warm(?:est)?|many|with)\s+)?(?:regards|wishes|rgds)|(?:thanks|thank you|many thanks)(?:\s(?:and|so much|in advance|very much|again).{0,30})?|cheers|br|kr|b/r|all the best|best|sincerely|(?:yours|your)(?:\s(?:sincerely|truly|faithfully))?|"
    r"with (?:appreciation|gratitude|thanks|best wishes)|respectfully|take care|"
    r"(?:bien )?cordialement|(?:sincères|meilleures) salutations|bien à vous|merci(?: d'avance| beaucoup)?|avec mes remerciements|salutations.{0,20}|"
    r"mit freundlichen grüßen|mit freundlichem gruß|(?:viele|beste|herzliche|freundliche|liebe|schöne) grüße|vielen dank(?: im voraus)?|danke|mfg|vg|hochachtungsvoll|"
    r"atentamente|(?:un |cordiales |muchos )?saludos?(?: cordiales| cordial)?|muchas gracias|gracias(?: de antemano)?|cordialmente|"
    r"atenciosamente|(?:com os melhores |melhores )?cumprimentos|(?:muito )?obrigad[oa]|abraços?|att|grat[oa]|"
    r"с уважением|с наилучшими пожеланиями|спасибо|заранее спасибо|благодарю|всего доброго|с благодарностью|"
    r"ב?ברכה(?: רבה)?|בברכת \S+|ב?תודה(?: רבה| מראש| ויום נעים| ויום טוב)?|בכבוד רב|שלך|שלכם|בהערכה(?: רבה)?|יום (?:טוב|נעים)|כל טוב|בידידות|"
    r"شكرا(?: جزيلا| لكم)?|مع (?:خالص )?(?:الشكر|التحية|التقدير|تحياتي|أطيب التحيات).{0,20}|تحياتي|وتفضلوا بقبول .{0,40}|مع الاحترام)\s*[,،.!;]?\s*$",
    re.I,
)
_SEPARATOR = re.compile(r"^\s*(?:--|---|—|–|__|___|~~+|\*\*\*)\s*$")
_CONTACT = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\+?\(?\d[\d\s().-]{6,}\d|^\s*(?:T|M|F|Tel|Mob|Mobile|Phone|Fax|E-?mail|Тел|Моб|טל|נייד|פקס|דוא\"ל|هاتف|جوال)\s*[.:]?\s*[+(]?\d", re.I)
_ENDS = re.compile(r"[.!?;:,…؟،]\s*$")
_NAME_LINE = re.compile(r"^\s*[^\W\d_][\w.'’׳-]*(?:\s+[^\W\d_][\w.'’׳-]*){0,3}\s*$")
_NO_CASE = re.compile("[֐-׿؀-ۿ]")
_ADDRESS = re.compile(r"\b\d{1,4}[A-Z]?,? [A-Z]|\d{5}|(?:רח|שד|דרך|רחוב|שדרות)|straße|strasse|gasse|\d{1,4}\s*$", re.I)
_VISIBLE = re.compile(r"\S")

NEW, HISTORY, NOTICE, SIGNATURE = 0, 1, 2, 3


def _name_like(line: str) -> bool:
    """One to four words, each with a capital where the script has them."""
    if not _NAME_LINE.match(line) or len(line) > 50:
        return False
    words = line.split()
    if _NO_CASE.search(line):
        return len(words) <= 3
    return all(w[0].isupper() or w in ("de", "da", "van", "von", "bin", "al", "of", "and") for w in words)


def _signature_like(line: str) -> bool:
    """A line that may stand in a signature below its first line: name, title, firm, contact, address."""
    text = line.strip()
    if len(text) > 80:
        return False
    if _CONTACT.search(text) or _ADDRESS.search(text) and len(text.split()) <= 12:
        return True
    return len(text.split()) <= (10 if "|" in text else 7) and not re.search(r"[.!?;…؟]\s*$", text)


class Labels:
    """Line labels of one body."""

    def __init__(self, body: str, names: tuple[str, ...] = (), endings=frozenset()):
        self.lines = [x.rstrip("\r") for x in body.split("\n")]
        self.seen = [bool(_VISIBLE.search(x)) for x in self.lines]
        self.label = [NEW] * len(self.lines)
        self.names, self.endings = names, endings

    def after(self, i: int) -> int | None:
        """The next line with something visible."""
        for j in range(i + 1, len(self.lines)):
            if self.seen[j]:
                return j
        return None

    def history(self) -> None:
        lines, label, n = self.lines, self.label, len(self.lines)
        marked = [bool(_MARK.match(x)) for x in lines]
        bars = [i for i in range(n) if lines[i].lstrip()[:1] == "|" and not lines[i].rstrip().endswith("|")]
        if len(bars) > 1 and any(marked[i] for i in bars):
            for i in bars:
                marked[i] = True  # a bar within a line of a quotation marked by bars
        for i in range(n):
            if marked[i]:
                label[i] = HISTORY
        i = 0
        while i < n:
            line = lines[i]
            if not self.seen[i]:
                i += 1
                continue
            last = self._intro_end(i)
            if last is not None:
                j = self.after(last)
                for k in range(i, last + 1):
                    label[k] = HISTORY
                if j is not None and marked[j]:
                    i = last + 1  # a marked quotation: its lines are marked already, what stands between them is new
                    continue
                if j is not None:
                    self._rest(i)
                return
            start = self._header_block(i)
            if start is not None:
                depth = marked[i]
                if depth:
                    i = start
                    continue
                self._rest(i)
                return
            i += 1

    def _intro_end(self, i: int) -> int | None:
        """Where an introducing line that begins at i ends: it may be wrapped over up to three lines."""
        line = self.lines[i]
        joined = line.rstrip()
        if len(joined) > 300 or joined.endswith((".", "!", "?")) or not _HINT.search(joined):
            return None
        if _INTRO.match(joined):
            return i
        if joined.endswith(":"):
            return None
        for j in (i + 1, i + 2):
            if j >= len(self.lines) or not self.seen[j] or len(joined) > 200:
                return None
            part = _MARKS.sub("", self.lines[j]).strip()
            joined = joined + ("" if joined.endswith("<") else " ") + part
            if part.endswith(":") and _INTRO.match(joined) and not _INTRO.match(part):
                return j
        return None

    def _header_block(self, i: int) -> int | None:
        """The line after the introducing lines of a forwarded message that begin at i."""
        line = self.lines[i]
        if _BEGIN.match(line):
            return i + 1
        j = i
        if _RULE.match(line):
            j = self.after(i)
            if j is None:
                return None
        m = _HEAD.match(self.lines[j])
        if not m:
            return None
        kinds, values = {m.lastgroup if m.lastgroup != "value" else next(k for k in _HEADS if m.group(k))}, 1
        k = j + 1
        while k < len(self.lines) and self.seen[k]:
            m = _HEAD.match(self.lines[k])
            if m:
                kinds.add(next(x for x in _HEADS if m.group(x)))
                values += 1
            elif values < 2:
                break
            k += 1
            if values >= 5:
                break
        return k if len(kinds) >= 3 or len(kinds) == 2 and "date" in kinds | {"from"} and ("from" in kinds or "date" in kinds) and "subject" in kinds | {"date"} and values >= 2 and ("from" in kinds) else None

    def _rest(self, i: int) -> None:
        for k in range(i, len(self.lines)):
            self.label[k] = HISTORY

    def notices(self) -> None:
        """A notice runs from its first line to the next blank line."""
        n, i = len(self.lines), 0
        while i < n:
            if self.label[i] == NEW and self.seen[i] and _NOTICE.match(self.lines[i]) and (i == 0 or not self.seen[i - 1] or self.label[i - 1] != NEW or _DEVICE.match(self.lines[i - 1]) or _NOTICE.match(self.lines[i - 1])):
                while i < n and self.seen[i] and self.label[i] == NEW:
                    self.label[i] = NOTICE
                    i += 1
            else:
                i += 1

    def stretches(self):
        """First and last visible line of each stretch of new lines."""
        n, i = len(self.lines), 0
        while i < n:
            if self.label[i] != NEW or not self.seen[i]:
                i += 1
                continue
            j = i
            while j < n and (self.label[j] == NEW or not self.seen[j]):
                j += 1
            yield i, max(k for k in range(i, j) if self.seen[k] and self.label[k] == NEW)
            i = j

    def signatures(self) -> None:
        """The end of each stretch of new lines."""
        for first, last in list(self.stretches()):
            self._sign(first, last)

    def trailing(self) -> set[str]:
        """The last lines of each stretch of new lines, which are endings if the sender repeats them; the first line of a stretch is none."""
        return {self.lines[k].strip() for first, last in self.stretches() for k in [k for k in range(first + 1, last + 1) if self.seen[k]][-ENDING_LINES:]}

    def _sign(self, first: int, last: int) -> None:
        lines, seen = self.lines, self.seen
        cut = None
        k, used = last, 0
        while k >= first and used < ENDING_LINES:
            line = lines[k]
            if not seen[k]:
                k -= 1
                continue
            if _DEVICE.match(line):
                cut = k
            elif _SEPARATOR.match(line):
                cut = k
                break
            elif _FAREWELL.match(line):
                # A lone word of thanks above more text is the sender's: something must follow, or the name be missing at the very end.
                if used or k == last and self._alone(k, first):
                    cut = k
                break
            elif line.strip().lower() in self.names or line.strip() in self.endings and self._alone(k, first):
                cut = k
            elif not _signature_like(line):
                break
            elif _name_like(line) and self._heads_block(k, first, last):
                cut = k
            used += 1
            k -= 1
        if cut is not None:
            for x in range(cut, last + 1):
                if seen[x]:
                    self.label[x] = SIGNATURE

    def _alone(self, k: int, first: int) -> bool:
        """A farewell as the last line, or an ending, with text above."""
        return k > first and any(self.seen[x] for x in range(first, k))

    def _heads_block(self, k: int, first: int, last: int) -> bool:
        """A name that nothing but a signature follows, and that does not end a wrapped paragraph."""
        if k == first and not any(self.label[x] != NEW for x in range(k)) and k == last:
            return False
        below = [x for x in range(k + 1, last + 1) if self.seen[x]]
        above = self.lines[k - 1] if k else ""
        set_off = not _VISIBLE.search(above) or bool(re.search(r"[.!?;:…؟]\s*$", above)) or (k and self.label[k - 1] != NEW)
        return bool(set_off) and (not below or all(_signature_like(self.lines[x]) or _DEVICE.match(self.lines[x]) for x in below)) and (len(self.lines[k].split()) >= 2 or any(_CONTACT.search(self.lines[x]) for x in below))


class Automaton:
    """Generalised suffix automaton over words; texts are added one after another."""

    __slots__ = ("go", "link", "size")

    def __init__(self):
        self.go, self.link, self.size = [{}], [-1], [0]

    def add(self, words: list[str]) -> None:
        go, link, size = self.go, self.link, self.size
        last = 0
        for w in words:
            q = go[last].get(w)
            if q is not None:
                if size[q] == size[last] + 1:
                    last = q
                    continue
                last = self._clone(last, q, w)
                continue
            cur = len(size)
            size.append(size[last] + 1)
            go.append({})
            link.append(0)
            p = last
            while p >= 0 and w not in go[p]:
                go[p][w] = cur
                p = link[p]
            if p >= 0:
                q = go[p][w]
                link[cur] = q if size[q] == size[p] + 1 else self._clone(p, q, w)
            last = cur

    def _clone(self, p: int, q: int, w: str) -> int:
        go, link, size = self.go, self.link, self.size
        c = len(size)
        size.append(size[p] + 1)
        go.append(dict(go[q]))
        link.append(link[q])
        link[q] = c
        while p >= 0 and go[p].get(w) == q:
            go[p][w] = c
            p = link[p]
        return c

    def runs(self, words: list[str], least: int) -> list[tuple[int, int]]:
        """Maximal stretches (from, to) of the words that occur in an added text, each at least so long."""
        go, link, size = self.go, self.link, self.size
        out, s, n = [], 0, 0
        for i, w in enumerate(words):
            while s and w not in go[s]:
                s = link[s]
                n = size[s]
            q = go[s].get(w)
            if q is None:
                s, n = 0, 0
            else:
                s, n = q, n + 1
            if n >= least:
                if out and out[-1][1] >= i - n + 1:
                    out[-1] = (min(out[-1][0], i - n + 1), i + 1)
                else:
                    out.append((i - n + 1, i + 1))
        return out


_WORDS = re.compile(r"\S+")


def words_of(body: str) -> tuple[list[str], list[int]]:
    """The words without quote marks, and the line of each."""
    words, at = [], []
    for k, line in enumerate(body.split("\n")):
        for w in _MARKS.sub("", line).split():
            words.append(w)
            at.append(k)
    return words, at


def _names(sender_name, sender_email) -> tuple[str, ...]:
    out = []
    if sender_name:
        out += [sender_name.strip().lower(), sender_name.strip().lower().split(" ")[0]]
    if sender_email and "@" in sender_email:
        parts = [p for p in re.split(r"[._-]", sender_email.split("@")[0].lower()) if p]
        if len(parts) == 2:
            out += [" ".join(parts), parts[0]]
    return tuple(x for x in out if x)


def label_lines(body: str, sender_name=None, sender_email=None, inherited: list[int] | None = None, endings=frozenset()) -> list[int]:
    """A label for each line: 0 new, 1 history, 2 notice, 3 signature. inherited: lines the automaton marked; endings: of the sender."""
    return _sign_labels(body, _unsigned(body, inherited), sender_name, sender_email, endings)


def _unsigned(body: str, inherited=()) -> list[int]:
    """Labels before signatures are looked for."""
    x = Labels(body)
    x.history()
    for k in inherited or ():
        if x.label[k] == NEW:
            x.label[k] = HISTORY
    x.notices()
    return x.label


def _sign_labels(body: str, labels: list[int], sender_name, sender_email, endings=frozenset()) -> list[int]:
    x = Labels(body, _names(sender_name, sender_email), endings)
    x.label = labels
    x.signatures()
    return x.label


def clean_text(body: str, labels: list[int]) -> str:
    """The new lines, with runs of blank lines made one."""
    kept = [x.rstrip("\r") for x, l in zip(body.split("\n"), labels) if l == NEW]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(kept)).strip()


def quoted_share(body: str, labels: list[int]) -> float:
    sizes = [len(x.strip()) for x in body.split("\n")]
    return sum(s for s, l in zip(sizes, labels) if l == HISTORY) / max(1, sum(sizes))


def _whole_lines(runs: list[tuple[int, int]], at: list[int]) -> list[int]:
    """Lines of which runs of words hold all but a few words: a run may begin or end within a line of the sender's."""
    size, out = Counter(at), []
    for a, b in runs:
        out += [k for k, n in Counter(at[a:b]).items() if n >= 0.8 * size[k]]
    return out


def _thread_labels(rows):
    """Labels without signatures of the messages of one thread, in order: ``(row, labels, name, email)``, the latter of the first copy. rows: (seq, key, body, name, email)."""
    done: dict[str, tuple] = {}
    distinct = {r[2].replace("\r", "") for r in rows if r[2]}
    auto = Automaton() if len(distinct) > 1 else None
    ids_in: set[str] = set()
    for row in rows:
        seq, mid, body, name, email = row
        if not body:
            yield row, [], name, email
            continue
        plain = body.replace("\r", "")
        got = done.get(plain)
        if got is None:
            inherited = []
            if auto is not None:
                words, at = words_of(plain)
                if not (mid and mid in ids_in):  # another copy of a message inherits nothing from it
                    inherited = _whole_lines(auto.runs(words, INHERITED_WORDS), at)
                auto.add(words)
                if mid:
                    ids_in.add(mid)
            got = done[plain] = _unsigned(plain, inherited), name, email
        yield row, *got


def _threads(batches):
    """Each thread's rows, from record batches in which threads lie together."""
    now, rows = None, []
    for t, *row in _rows(batches, "t", "seq", "mid", "body", "name", "email"):
        if t != now:
            if rows:
                yield rows
            now, rows = t, []
        rows.append(tuple(row))
    if rows:
        yield rows


def _mapped(df: DataFrame, each, schema: str) -> DataFrame:
    """Rows that ``each`` makes of an iterator over record batches, in batches of bounded size."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    names = [f.split()[0] for f in schema.split(", ")]
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        out = []
        for rows in each(batches):
            out += rows
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), arrow)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), arrow)], names)

    return df.mapInArrow(run, schema)


def _rows(batches, *columns):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


_JUDGED = "seq bigint, body string, name string, email string, labels string"


def _judged(messages: DataFrame) -> DataFrame:
    """``(seq, body, name, email, labels)``: labels without signatures, a digit a line; name and email of the first copy in the thread."""
    from missiva.functions.ids import canonical_id

    rows = messages.select(
        F.coalesce(F.nullif(F.trim("thread_key"), F.lit("")), F.concat(F.lit("row:"), F.col("ingest_seq").cast("string"))).alias("t"),
        F.col("ingest_seq").cast("bigint").alias("seq"),
        canonical_id("message_id").alias("mid"),
        F.col("body_text_raw").alias("body"),
        F.col("sender_name").alias("name"),
        F.col("sender_email").alias("email"),
        F.coalesce(F.col("sent_at"), F.col("received_at")).alias("at"),
    )
    sizes = messages.filter("trim(thread_key) <> ''").groupBy(F.trim("thread_key").alias("t")).agg(F.count("*").alias("n"))
    long = cut(sizes.filter(F.col("n") > THREAD_WINDOW).select("t"))  # a written table: its size is known, and a small one is broadcast
    some = not long.isEmpty()
    short = rows.join(long, "t", "left_anti") if some else rows

    def each(batches):
        for thread in _threads(batches):
            yield [(row[0], row[2], name, email, "".join(map(str, labels))) for row, labels, name, email in _thread_labels(thread)]

    out = _mapped(short.repartition("t").sortWithinPartitions("t", "at", "seq").drop("at"), each, _JUDGED)
    return out.unionByName(_judged_long(rows.join(long, "t", "left_semi"))) if some else out


def _judged_long(rows: DataFrame) -> DataFrame:
    """The same for threads of any length, without ever holding one.

    A run is inherited where each stretch of INHERITED_WORDS words in it occurs in an earlier
    message, so the stretches' 128-bit hashes, joined to the first message with each, mark the same
    words as an automaton over the whole thread.
    """
    rows = rows.withColumns({"at": F.coalesce(F.unix_micros("at"), F.lit(-(2**63))), "text": F.md5(F.replace("body", F.lit("\r"), F.lit("")))})
    order = F.struct("at", "seq")
    first = rows.filter("body <> ''").groupBy("t", "text").agg(F.min(order).alias("o")).select(F.col("o.seq").alias("seq"))
    heads = cut(rows.join(first, "seq", "left_semi"))  # the first copy of each body
    ids = heads.filter("mid IS NOT NULL").groupBy("t", "mid").agg(F.min(order).alias("o"))
    copies = heads.join(ids, ["t", "mid"]).filter(order > F.col("o")).select("seq")  # another copy of a message inherits nothing from it

    def hashes(batches):
        for t, at, seq, body in _rows(batches, "t", "at", "seq", "body"):
            words, start = words_of(body.replace("\r", ""))[0], hashlib.blake2b(f"{t}\n".encode("utf-8", "surrogatepass"), digest_size=16)
            got = []
            for k in range(len(words) - INHERITED_WORDS + 1):
                h = start.copy()
                h.update(" ".join(words[k : k + INHERITED_WORDS]).encode("utf-8", "surrogatepass"))
                got.append((h.digest(), at, seq, k))
            yield got

    parts = _mapped(heads.select("t", "at", "seq", "body"), hashes, "h binary, at bigint, seq bigint, k int")
    again = parts.groupBy("h").agg(F.min(order).alias("o"), F.max(order).alias("last")).filter("o < last").select("h", "o")
    found = parts.join(again, "h").filter(order > F.col("o")).groupBy("seq").agg(F.collect_list("k").alias("ks")).join(copies, "seq", "left_anti")

    def each(batches):
        for t, text, body, name, email, ks in _rows(batches, "t", "text", "body", "name", "email", "ks"):
            plain, runs = body.replace("\r", ""), []
            for k in sorted(ks or ()):
                if runs and runs[-1][1] >= k:
                    runs[-1] = (runs[-1][0], k + INHERITED_WORDS)
                else:
                    runs.append((k, k + INHERITED_WORDS))
            yield [(t, text, name, email, "".join(map(str, _unsigned(plain, _whole_lines(runs, words_of(plain)[1])))))]

    judged = _mapped(heads.join(found, "seq", "left").select("t", "text", "body", "name", "email", "ks"), each, "t string, text string, head_name string, head_email string, labels string")
    own = F.col("labels").isNull()  # null and empty bodies
    return rows.join(judged, ["t", "text"], "left").select(
        "seq", "body", F.when(own, F.col("name")).otherwise(F.col("head_name")).alias("name"), F.when(own, F.col("email")).otherwise(F.col("head_email")).alias("email"), F.coalesce("labels", F.lit("")).alias("labels"),
    )


def _sender(email: str = "email"):
    return F.nullif(F.lower(F.trim(email)), F.lit(""))


def sender_endings(judged: DataFrame) -> DataFrame:
    """``(sender, endings)``: the lines with which a sender ends text again and again.

    Bodies count once for each sender however often they were delivered. The share bounds the
    endings of a sender; distinct lines are counted before senders, so a busy sender is no hot key.
    """

    def each(batches):
        for sender, body, labels in _rows(batches, "sender", "body", "labels"):
            x = Labels(body.replace("\r", ""))
            x.label = list(map(int, labels))
            yield [(sender, hash_of(body.replace("\r", "")), line) for line in (None, *x.trailing())]

    lines = judged.select(_sender().alias("sender"), "body", "labels").filter("sender IS NOT NULL AND body <> ''")
    counts = _mapped(lines, each, "sender string, h bigint, line string").distinct().groupBy("sender", "line").agg(F.count("*").alias("n"))  # the null line counts bodies
    per = counts.groupBy("sender").agg(F.max(F.when(F.col("line").isNull(), F.col("n"))).alias("bodies"), F.collect_list(F.when(F.col("line").isNotNull() & (F.col("n") >= ENDING_BODIES), F.struct("line", "n"))).alias("l"))
    often = F.filter("l", lambda x: x["n"] >= ENDING_SHARE * F.col("bodies"))
    return per.select("sender", F.transform(often, lambda x: x["line"]).alias("endings")).filter("size(endings) > 0")


def hash_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _run(messages: DataFrame, emit, schema: str) -> DataFrame:
    judged = cut(_judged(messages))  # read for the endings and for the labels
    ends = cut(sender_endings(judged)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = judged.withColumns({"sender": _sender(), "salt": F.pmod("seq", F.lit(SALTS)).cast("int")}).join(ends, ["sender", "salt"], "left")

    def each(batches):
        for seq, body, name, email, labels, endings in _rows(batches, "seq", "body", "name", "email", "labels", "endings"):
            labels = _sign_labels(body.replace("\r", ""), list(map(int, labels)), name, email, frozenset(endings or ())) if labels else []
            yield emit(seq, body, labels)

    return _mapped(rows.select("seq", "body", "name", "email", "labels", "endings"), each, schema)


def lines_not_new(messages: DataFrame) -> DataFrame:
    """``(ingest_seq, line_no, kind)``: each line with a visible character that its sender did not newly write.

    kind: history, notice or signature. Lines end at LF and count from 1. Null and empty bodies
    have no lines; copies of a message are judged alike, each for itself; rows without a thread
    key are threads of their own. Whole bodies are read.
    """
    kinds = {HISTORY: "history", NOTICE: "notice", SIGNATURE: "signature"}

    def emit(seq, body, labels):
        lines = body.split("\n") if labels else ()
        return [(seq, k + 1, kinds[l]) for k, (l, x) in enumerate(zip(labels, lines)) if l != NEW and _VISIBLE.search(x)]

    return _run(messages, emit, "ingest_seq bigint, line_no int, kind string")


def newly_written(messages: DataFrame) -> DataFrame:
    """``(ingest_seq, body_text_clean, mostly_quoted)``: the new text of each message.

    mostly_quoted: history makes 60 per cent of the visible characters or more, or nothing new is
    left of a body that had something. A null body gives null and false, an empty one "".
    """

    def emit(seq, body, labels):
        if not body:
            return [(seq, body, False)]
        new = clean_text(body, labels)
        return [(seq, new, quoted_share(body, labels) >= 0.6 or not new and HISTORY in labels)]

    return _run(messages, emit, "ingest_seq bigint, body_text_clean string, mostly_quoted boolean")
