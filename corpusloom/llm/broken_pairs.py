"""Defects of prompt and response pairs, by ordered rules.

The rules run in the order of ``DEFECTS``, each over the whole texts; ``defects`` of a pair holds every one that is triggered and
``defect`` the first.  Only the two texts of a pair reach Python, in Arrow batches; nothing is shuffled.

empty           no letter or digit is left after hidden reasoning, tags, invisible characters and punctuation are taken away
truncated       a bracket, brace, quotation of a list or code fence stays open, or the text ends inside a sentence or item
refusal         a clause declines in one of the languages below, and at least half of all words stand in clauses that decline, apologise,
                give the reason for it or take leave, so that no answer is given besides
copy            four fifths of the answer's runs of three words are runs of the prompt (of a shorter answer: its words begin the prompt)
other_language  the answer's script, function words, letters and endings belong to another language than the prompt asks for, or is written in
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.workspace import spread

DEFECTS = ("empty", "truncated", "refusal", "copy", "other_language")
#: Share of an answer's runs of three words that makes it a copy.
COPIED = 0.8

# Function words by language (fixed lists).
FUNCTION_WORDS = {
    "en": "the of and to in is for with its it on at by from as was were that which while only but yet after before so than this you your what why when whose where has have had be are not into until",
    "de": "der die das und ist mit von bei den dem des ein eine einer einen auf für nur nicht wird werden im zu zum zur aus am an als auch oder sich wie um bis gegen unter über nach sobald davon etwas ich du",
    "fr": "le la les des du de et est à au aux dans pour avec une un sur que qui plus sans par ce cette ces son sa ses puis car dont ne pas en il elle je tu vous nous entre autour malgré",
    "es": "el la los las de del en y que con un una por para se su sus al es no más lo como pese cuando entre hasta sobre ante unos unas este esta yo tú cerca antes porque",
    "it": "il lo la gli i di del della con una un più per che è nel nella al alla dei delle non sono e fino da vicino ho dal dalla come si",
    "pt": "o os as de do da dos das em no na com um uma para que não mais por ao à e é mas como até foi são se",
    "nl": "de het een van en met op voor niet is dat die te in aan door naar bij wordt zijn maar om als ook",
}
_SPEAKS: dict[str, list[str]] = {}
for _k, _v in FUNCTION_WORDS.items():
    for _w in _v.split():
        _SPEAKS.setdefault(_w, []).append(_k)
# Letters and word endings that speak for a language (fixed lists); those of several share a vote.
_LETTERS: dict[str, list[str]] = {}
for _k, _v in {"de": "äöüß", "fr": "éèêëàâçœîïûù", "es": "éáíóúñ¿¡", "pt": "éáíóúãõçâê", "it": "èàòìù", "nl": "ëï"}.items():
    for _w in _v:
        _LETTERS.setdefault(_w, []).append(_k)
_MARKED = re.compile("[" + "".join(_LETTERS) + "]")
_ENDINGS = {
    "ción": ["es"], "dad": ["es"], "mente": ["es", "it", "pt"], "ando": ["es", "it", "pt"], "zione": ["it"], "ção": ["pt"], "dade": ["pt"], "tion": ["fr", "en"], "ment": ["fr", "en"], "eur": ["fr"], "eux": ["fr"], "aux": ["fr"], "ique": ["fr"],
    "ung": ["de"], "keit": ["de"], "lich": ["de"], "isch": ["de"], "schaft": ["de"], "ing": ["en"], "ness": ["en"], "ally": ["en"], "heid": ["nl"], "lijk": ["nl"],
}
_SCRIPTS = (
    ("ja", re.compile("[぀-ヿ]")), ("zh", re.compile("[一-鿿]")), ("ko", re.compile("[가-힯]")), ("ru", re.compile("[Ѐ-ӿ]")), ("ar", re.compile("[؀-ۿ]")),
    ("el", re.compile("[Ͱ-Ͽ]")), ("he", re.compile("[֐-׿]")), ("hi", re.compile("[ऀ-ॿ]")), ("th", re.compile("[฀-๿]")),
)
_EXTENDED_LATIN = re.compile("[\x00-ɏ‐-⁯€]*")
_LATIN = re.compile("[A-Za-zÀ-ɏ]")
# Names of languages as prompts ask for them (fixed list).
LANGUAGE_NAMES = {
    "en": "english englisch anglais inglés ingles inglese", "de": "german deutsch allemand alemán aleman tedesco", "fr": "french französisch français francais francés frances francese",
    "es": "spanish spanisch espagnol español espanol castellano spagnolo", "it": "italian italienisch italien italiano", "pt": "portuguese portugiesisch portugais portugués português",
    "nl": "dutch niederländisch néerlandais neerlandés", "ja": "japanese japanisch japonais japonés", "zh": "chinese chinesisch chinois chino", "ru": "russian russisch russe ruso",
}
_NAMED = {w: k for k, v in LANGUAGE_NAMES.items() for w in v.split()}
_IN = re.compile(r"\b(?:in|auf|en|em)\s+(" + "|".join(sorted(_NAMED, key=len, reverse=True)) + r")\W*$", re.I)
_ASK = re.compile(r"\b(?:answer|reply|respond|write|antworte\w*|schreib\w*|réponds?|répondez|responde|responda|contesta|escribe|rispondi)\b(?:[^.?!\n]{0,30}?)\b(?:in|auf|en|em)\s+(" + "|".join(sorted(_NAMED, key=len, reverse=True)) + r")\b", re.I)
# Ways to decline (fixed lists), over lower-cased text with straight apostrophes; each with a string that every match holds.
_DO = r"(?:help|assist|say anything|listen|judge|process|answer|comply|provide|do (?:this|that|it)|continue|give|hear (?:files|audio|sound|the)|access|open|discuss|work on|fulfil|create|complete|engage|offer|evaluate|rate)"
_DECLINES = [
    (held, re.compile(pattern))
    for held, pattern in (
        ("i can't", r"\bi can't " + _DO), ("i cannot", r"\bi cannot " + _DO), ("i can not", r"\bi can not " + _DO), ("i could", r"\bi could(?: not|n't) " + _DO), ("able to", r"\bi(?: won't be | will not be | am not | am un|'m un)able to " + _DO),
        ("able to", r"\bi(?:'m| am) (?:unable|not able) to\b"), ("i wo", r"\bi won't (?:help|assist|answer|judge|do|provide|comply|work)"), ("i will not", r"\bi will not (?:help|assist|answer|judge|do|provide|comply|work)"),
        ("decline", r"\bi (?:must|have to|need to) decline (?:to\b|this|your|the request)"), ("refuse", r"\bi (?:must|have to|need to) refuse (?:to\b|this|your|the request)"), ("i decline", r"\bi decline to\b"), ("i refuse", r"\bi refuse to\b"), ("rather not", r"\bi(?:'d| would) rather not\b"),
        ("have the", r"\bi (?:don't|do not) have the (?:ability|means|tools)"), ("i have no", r"\bi have no (?:way|access|means|ability)"), ("not possible", r"\bnot possible for me to\b"), ("something i can", r"\b(?:isn't|is not|not) something i can\b"), ("beyond what i", r"\bbeyond what i can\b"),
        ("outside what i", r"\boutside what i (?:do|can)\b"), ("no answer", r"\bno answer can be given\b"), ("guidelines", r"\bagainst my guidelines\b"), ("as an ai", r"\bas an ai\b[^.]*\b(?:can't|cannot|unable|not)\b"),
        (" ich ", r"\b(?:kann|könnte|darf|möchte|werde) ich (?:dir |ihnen |euch |das |dies |dabei |hier |darauf |leider |es )*nicht\b"), ("ich ", r"\bich (?:kann|darf|möchte|werde) (?:dir |ihnen |das |dies |dabei |darauf |hier |leider )*nicht\b"), ("nicht möglich", r"\b(?:es ist|ist es|ist) mir (?:leider )?nicht möglich\b"),
        ("in der lage", r"\bich bin (?:leider )?nicht in der lage\b"), ("ablehnen", r"\bmuss ich (?:leider )?ablehnen\b"),
        ("je ne", r"\bje ne (?:peux|puis|saurais) (?:malheureusement )?(?:pas\b)?"), ("je ne suis", r"\bje ne suis pas (?:en mesure|capable|autorisé)"), ("impossible", r"\bm'est impossible\b"), ("impossible", r"\bimpossible (?:pour moi )?de répondre\b"), ("je ", r"\bje (?:dois|préfère) (?:refuser|décliner|ne pas)\b"), ("je refuse", r"\bje refuse de\b"),
        ("no p", r"\bno (?:puedo|podré|podría) (?:ayudar|responder|escuchar|juzgar|opinar|hacer|decir|procesar|contestar|abrir|evaluar)"), ("imposible", r"\bme es imposible\b"), ("no ", r"\bno (?:soy|estoy) (?:capaz|en condiciones)\b"), ("debo ", r"\bdebo (?:rechazar|negarme)\b"), ("prefiero no", r"\bprefiero no\b"),
        ("non ", r"\bnon (?:posso|sono in grado)\b"), ("não ", r"\bnão (?:posso|consigo) (?:ajudar|responder|ouvir|avaliar)"),
    )
]


def _declines(text: str) -> bool:
    return any(held in text and pattern.search(text) for held, pattern in _DECLINES)


# What goes with declining: apologies, reasons and leave-taking (fixed lists).
_COURTESY = re.compile(
    "|".join(
        (
            r"\b(?:sorry|apologi[sz]e|apologies|unfortunately|regret|afraid)\b", r"\bplease (?:ask|try|consult|contact|feel|let)\b", r"\b(?:anything|something) else\b", r"\b(?:hope|trust) (?:that )?you\b", r"\bunderstand(?:ing)?\b", r"\blet me know\b", r"\bthank(?:s| you)\b",
            r"\bguidelines?\b|\bpolic(?:y|ies)\b", r"\boutside what\b|\bbeyond (?:what|my)\b", r"\bas an? (?:ai|assistant|language model)\b", r"\bi (?:have|was given) no\b", r"\bi (?:do|am|can|could|will|would|was|have|may|must|should)(?: not|n't)\b", r"\bno access\b", r"\binstead\b", r"\bhappy to help\b", r"\byou (?:could|may|might|can) (?:try|ask|want|use|consult)\b",
            r"\b(?:leider|entschuldig\w*|verzeih\w*|bedau\w+|tut mir leid|verständnis|richtlinien|etwas anderes|andere frage|kann ich sonst|stattdessen)\b", r"\bich (?:habe|bin|kann|darf) (?:\w+ )?(?:kein\w*|nicht)\b",
            r"\b(?:désolée?|malheureusement|excuse\w*|regrette|compréhension|comprends|comprenez|règles|consignes|autre (?:chose|question))\b", r"\b(?:posez|essayez|demandez)\b", r"\bje n['e]",
            r"\b(?:lo siento|lamento|lamentablemente|disculp\w*|perdón|comprensión|comprendas?|entiendas?|normas|políticas|otra (?:cosa|pregunta)|algo más)\b", r"\b(?:pregunta|pregúntame|prueba|intenta)\b.*\botra\b", r"\bno (?:tengo|puedo|debo|soy)\b",
            r"\b(?:mi dispiace|purtroppo|scusa\w*|desculpe\w*|infelizmente|lamento)\b",
        )
    )
)
_THINK = re.compile(r"<(think|thinking|reasoning|scratchpad)>.*?(?:</\1>|\Z)", re.S | re.I)
_TAG = re.compile(r"</?[A-Za-z][\w:-]*(?:\s[^<>]*)?/?>|<\|[^<>|]*\|>")
_SENTENCE = re.compile(r"(?<=[.!?。！？])[\s\"'”’)\]]*(?=\S)|\n+")
_WORD = re.compile(r"[^\W_]+")
_PLAIN = re.compile(r"[^\W\d_]+")
_REASON = re.compile(r"\s*(?:as|since|because|da|weil|denn|car|puisque|parce|porque|pues|ya que|poiché|perché)\b")
_CLAUSE = re.compile(r"[,;:—–]")
_ITEM = re.compile(r"^(?:[-*•+]|\d{1,3}[.)])\s")
_DONE = re.compile(r"(?:[.!?…。！？؟।]|[.!?…。！？][\"'”’»)\]]+)$")
_LABEL = re.compile(r"^\w+(?:[ -]\w+){0,2}:(?:\s+\S+){1,6}$")
_CUT_NUMBER = re.compile(r"\b\d{1,3}\.$")


def _bare(answer: str | None) -> str:
    if not answer or "<" not in answer:
        return answer or ""
    return _TAG.sub(" ", _THINK.sub(" ", answer or ""))


def is_empty(answer: str | None) -> bool:
    return not any(c.isalnum() for c in _bare(answer))


def is_refusal(answer: str | None) -> bool:
    text = _bare(answer).strip().lower().replace("’", "'").replace("‘", "'")
    if not _declines(text):
        return False
    declines = aside = total = 0
    for sentence in _SENTENCE.split(text):
        declined = False  # in this sentence; a reason given for it belongs to it
        for clause in _CLAUSE.split(sentence or ""):
            n = len(_WORD.findall(clause))
            total += n
            if n and _declines(clause):
                declines, declined = declines + n, True
            elif n and (_COURTESY.search(clause) or declined and _REASON.match(clause)):
                aside += n
    return declines > 0 and 2 * (declines + aside) >= total


def is_copy(prompt: str | None, answer: str | None) -> bool:
    a, p = _WORD.findall(_bare(answer).lower()), _WORD.findall(_bare(prompt).lower())
    if not a or not p:
        return False
    if len(a) < 6:  # too short for a share: the prompt's beginning, and most of it
        return a == p[: len(a)] and len(a) >= 0.8 * len(p)
    runs = set(zip(p, p[1:], p[2:], strict=False))
    mine = list(zip(a, a[1:], a[2:], strict=False))
    return sum(x in runs for x in mine) >= COPIED * len(mine)


def _weights() -> dict[str, tuple[tuple[str, float], ...]]:
    """Of a function word, the languages that have it, which share one vote."""
    return {w: tuple((k, 1 / len(ks)) for k in ks) for w, ks in _SPEAKS.items()}


_VOTES = _weights()


def language(text: str) -> str | None:
    """Language by script, or by the votes of function words, letters and endings; null if the text doesn't say."""
    if not text.isascii() and not _EXTENDED_LATIN.fullmatch(text):
        latin = len(_LATIN.findall(text))
        for name, script in _SCRIPTS:
            n = len(script.findall(text))
            if n >= 4 and n * 3 > latin * (1 if name in ("ja", "zh", "ko") else 2):
                return name
    words = _PLAIN.findall(text.lower())
    votes: dict[str, float] = {}
    for w, n in Counter(words).items():
        for k, v in _VOTES.get(w, ()):
            votes[k] = votes.get(k, 0.0) + n * v
        if len(w) > 5 and (ks := _ENDINGS.get(w[-6:]) or _ENDINGS.get(w[-5:]) or _ENDINGS.get(w[-4:]) or _ENDINGS.get(w[-3:])):
            for k in ks:
                votes[k] = votes.get(k, 0.0) + n * 0.5 / len(ks)
    if not text.isascii():
        for c, n in Counter(_MARKED.findall(text.lower())).items():
            for k in _LETTERS[c]:
                votes[k] = votes.get(k, 0.0) + n * 0.5 / len(_LETTERS[c])
    top = sorted(votes.items(), key=lambda x: (-x[1], x[0]))[:2]
    if not top or top[0][1] < 1.5 or top[0][1] < 0.04 * len(words):
        return None
    return None if len(top) > 1 and top[1][1] > 0.75 * top[0][1] else top[0][0]


def is_other_language(prompt: str | None, answer: str) -> bool:
    got = language(_strip_code(_bare(answer)))
    if not got or not prompt:
        return False
    asked = _ASK.findall(prompt)
    if not asked:  # a short sentence that ends with the language, however the asking is worded
        asked = [m.group(1) for x in _SENTENCE.split(prompt) if x and len(x.split()) <= 5 and (m := _IN.search(x))]
    want = _NAMED[asked[-1].lower()] if asked else language(_bare(prompt))
    return bool(want and want != got)


def _strip_code(text: str) -> str:
    if "```" not in text:
        return text
    return re.sub(r"```.*?(?:```|\Z)", " ", text, flags=re.S)


def _open_bracket(text: str) -> bool:
    """Does a round, square or curly bracket of the last paragraph stay open?  Brackets inside double quotes don't count."""
    stack, quoted, skip = [], False, False
    for c in text:
        if skip:
            skip = False
        elif c == "\\":
            skip = True
        elif c == '"':
            quoted = not quoted
        elif quoted:
            continue
        elif c in "([{":
            stack.append(c)
        elif c in ")]}" and stack and "([{".index(stack[-1]) == ")]}".index(c):
            stack.pop()
    return bool(stack)


def is_truncated(answer: str) -> bool:
    text = answer.rstrip().rstrip("​﻿\xa0")
    if re.search(r"<(think|thinking|reasoning|scratchpad)>(?!.*</\1>)", text, re.S | re.I):
        return True
    if text.count("```") % 2:
        return True
    if text.endswith("```"):
        return False
    last = text.rsplit("\n", 1)[-1].strip()
    tail = re.split(r"```", text)[-1]
    if _open_bracket(last) or (last.startswith(("}", "]")) and _open_bracket(tail)):
        return True
    block = tail.strip()
    if block.startswith(("{", "[")) and _open_bracket(block):
        return True
    if not last or last.endswith((",", ":", ";", "(", "[", "{", "-", "–", "—", "=", "/", "&", "+")):
        return bool(last)
    if _CUT_NUMBER.search(last) and re.search(r"(?<![\d.])0\.$", last):
        return True
    if _DONE.search(last):
        return False
    if last.endswith(("}", "]", ")")):
        return False
    if _ITEM.match(last):  # a list item is complete when it has a value, as its neighbours do
        lines = [x.strip() for x in text.split("\n") if _ITEM.match(x.strip())]
        if ":" in last:
            return not last.rsplit(":", 1)[1].strip()
        others = [x for x in lines[:-1]]
        return bool(others) and (all(":" in x for x in others) or all(_DONE.search(x) for x in others)) or not others and len(last.split()) > 8
    if _LABEL.match(last):  # a labelled line holds a value, not a sentence
        return False
    if last.endswith(('"', "'", "”", "’", "»", "*", "`", "|", ">")):
        return last.count('"') % 2 == 1
    return True


def defects(prompt: str | None, answer: str | None) -> list[str]:
    """Every defect of a pair, in the order of DEFECTS."""
    rules = (is_empty(answer), is_truncated(answer or ""), is_refusal(answer), is_copy(prompt, answer), is_other_language(prompt, answer or ""))
    return [name for name, hit in zip(DEFECTS, rules, strict=True) if hit]


def broken_pairs(pairs: DataFrame) -> DataFrame:
    """(id, defects): the defective pairs of ``pairs(id, prompt, answer)`` with every defect in order.

    A null answer is empty; a null prompt can neither be copied nor set a language.  Whole texts are read, however long; equal rows are
    reported each; further columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        for batch in batches:
            ids, found = [], []
            for i, (p, a) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if d := defects(p, a):
                    ids.append(i)
                    found.append(d)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(found, pa.list_(pa.string()))], names=["id", "defects"])

    kind = pairs.schema["id"].dataType.simpleString()
    return spread(pairs.select("id", F.col("prompt").cast("string"), F.col("answer").cast("string"))).mapInArrow(run, f"id {kind}, defects array<string>")


def record_pairs(records: DataFrame) -> DataFrame:
    """(id, prompt, answer) of conversation records: the last user message and the closing message, null unless an assistant's."""
    users = F.filter("messages", lambda m: m["role"] == "user")
    close = F.try_element_at("messages", F.lit(-1))
    return records.select(F.col("input_seq").alias("id"), F.try_element_at(users, F.lit(-1))["content"].alias("prompt"), F.when(close["role"] == "assistant", close["content"]).alias("answer"))
