"""Sentences of texts in many languages and scripts, by cascading tables of break and no-break rules.

A rule is (break or not, pattern that ends at the place, pattern that begins there, what else must hold). Candidate
places are found first: behind marks that can end a sentence, behind emoji, at line breaks, at spaces between Thai
letters, behind Greek question marks, and behind quotations and brackets that end with such a mark. Each kind of
place has its cascade of tables (common exceptions, the languages of the script before the place, common breaks), and
the first rule that matches decides; without a match there is no break. Patterns look at the whole text, not at a
window of it, and what must hold (a wrapped line, small letters only, …) is told to the rules as facts of the place.

Languages are told by script around each place, not by the column ``lang``, which is often wrong, and texts mix
languages. Line breaks are soft in wrapped paragraphs: where the next word would not have fitted on the line.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import regex as re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Longest line of a paragraph that is taken for wrapped.
WRAP_LIMIT = 100

EMOJI = r"(?:[\U0001F000-\U0001FAFF☀-➿⭐⭕‼⁉](?:[️‍\U0001F3FB-\U0001F3FF]|‍[\U0001F000-\U0001FAFF☀-➿])*)"
END = r"[.!?…。！？।؟‼⁇｡．]"
OPEN = r"[\"“„«‹「『(\[（¿¡'‘”]"
START = rf"(?:{OPEN}*[\p{{Lu}}\p{{Lt}}\p{{N}}]|{OPEN}*[\p{{Lo}}]|[¿¡])"

#: Abbreviations that only are some before a number; elsewhere they can be words.
BEFORE_NUMBER = "no nos ok n nr ext núm nº max min máx mín"
# Abbreviations after which a sentence goes on, by language.
ABBREVIATIONS = {
    "latin": {
        "en": "mr mrs ms dr st prof approx p pp vs e.g i.e fig jr",
        "de": "hr hrn fr str ca bzw z.b d.h u.a dr prof zzgl inkl tel",
        "fr": "mm mme mlle cf env av bd p.ex",
        "es": "sr sra srta dr dra avda aprox pág",
        "it": "sig sigg dott dott.ssa p.zza ca",
        "pt": "sr sra dr dra av aprox",
        "pl": "ul np p dr pl al",
        "sv": "t.ex bl.a ca kl",
        "tr": "cad örn sok dr yakl",
    },
    "cyrillic": {"ru": "ул д напр ок г-н г-жа стр кв им т.е т.к"},
    "greek": {"el": "κ κα π.χ περ σελ αρ οδ"},
    "devanagari": {"hi": "डॉ रु श्री प्रो"},
    "arabic": {"ar": "د أ م ص"},
    "thai": {"th": "น ดร"},
}


def _words(s: str) -> str:
    return "|".join(re.escape(w).replace(r"\.", r"\.\s?") for w in sorted(s.split(), key=len, reverse=True))


class Rule(NamedTuple):
    breaks: bool
    before: re.Pattern | None
    after: re.Pattern | None
    needs: frozenset
    bars: frozenset


class Table(NamedTuple):
    """Rules in their order, and one pattern that holds wherever one of theirs before the place does."""

    rules: tuple[Rule, ...]
    before: re.Pattern | None


def _rule(breaks: bool, before: str, after: str, *facts: str) -> tuple:
    """facts: names of what must hold, or with ! before it must not."""
    return breaks, before, after, facts


def _table(*rules: tuple) -> Table:
    behind = lambda *x: re.compile("(?<=" + "|".join(f"(?:{y})" for y in x) + ")")
    facts = lambda f, bar: frozenset(x.lstrip("!") for x in f if (x[0] == "!") is bar)
    return Table(tuple(Rule(b, behind(x) if x else None, re.compile(y) if y else None, facts(f, False), facts(f, True)) for b, x, y, f in rules), None if any(not x for _, x, _, _ in rules) else behind(*(x for _, x, _, _ in rules)))


#: Exceptions of every language.
NO_BREAK = _table(
    # A sentence that begins with a year, the space before it lost.
    _rule(True, r"\p{L}{3}\.", r"\p{N}{4}\s\p{L}"),
    _rule(False, r"\p{N}[.．]", r"\p{N}"),
    _rule(False, r"[\p{L}\p{N}/@]\.", r"[\p{Ll}\p{N}]"),
    _rule(False, END, r"[,;:)\]»”’]|\s+[,;:)]"),
    _rule(False, r"(?<![\p{L}\p{N}])\p{Lu}\.", r"\s*\p{Lu}"),
    _rule(False, r"(?<![\p{L}\p{N}])\p{Lu}\.", r"\p{L}"),
    _rule(False, r"(?<![\p{L}])[Cc]o\.", r"\s*(?:Ltd|Inc|KG|OHG|&)"),
    _rule(False, r"(?<![\p{L}])[aApP]\.", r"\s?[mM]\b"),
)
#: Tables by script: the abbreviations of its languages, then what else they need.
LANGUAGE = {
    script: [_rule(False, rf"(?<![\p{{L}}\p{{M}}])(?i:{_words(' '.join(by.values()))})\.", r"\s*\S")] for script, by in ABBREVIATIONS.items()
}
LANGUAGE["latin"] += [
    _rule(False, rf"(?<![\p{{L}}])(?i:{_words(BEFORE_NUMBER)})\.", r"\s*\p{N}"),
    _rule(False, r"(?<![\p{L}])[zdu]\.", r"\s?(?:[BhaÄÜ]\b|ä\b|U\b)"),
    # German ordinals before a noun.
    _rule(False, r"\b(?:[AaIi]m|[Vv]om|[Zz]um|[Dd](?:er|en|em|ie|as)|[Bb]is|[Ss]eit dem)\s+\p{N}{1,2}\.", r"\s+\p{L}"),
]
LANGUAGE["cyrillic"] = [_rule(True, r"\bт\.\s?[дп]\.", r"\s+[^\p{Ll}\s]")] + LANGUAGE["cyrillic"] + [_rule(False, r"\b[тд]\.", r"\s?[дпек]\b"), _rule(False, r"\bг\.", r"\s*\p{Ll}")]
LANGUAGE["thai"] += [_rule(False, r".", r"\s*เป็นต้นไป")]
TABLES = {script: _table(*rules) for script, rules in LANGUAGE.items()}
#: What ends a sentence.
BREAK = _table(
    _rule(True, r"[。！？｡]", r""),
    _rule(True, r"।", r""),
    _rule(True, rf"{END}", r"\s*\Z"),
    _rule(True, r"[!?؟…]", r"\s*[\p{Lo}]"),
    _rule(True, rf"{END}", rf"\s+(?:{START}|[-–—*•€$£<&={{#]|{EMOJI})"),
    _rule(True, r"[\p{Ll}\p{Lo}\p{M}\p{N}\)%²€]{2}[.!?…؟]+", rf"(?:{OPEN}*\p{{Lu}}|{OPEN}*\p{{Lo}}|[¿¡«“„「(])"),
    _rule(True, r"[!?…]", rf"(?:{OPEN}*\p{{Lu}}|[¿¡«“„「(]|\p{{N}})"),
    _rule(True, rf"{END}", r"\s+[^\p{L}\p{N}\s,;:)\]»]"),
    # In lines without capitals a small letter can begin a sentence.
    _rule(True, rf"{END}", r"\s+\p{L}", "small"),
)
_CLOSED = rf"(?:{END}|;|{EMOJI})[\"”’»」』)\]）]*"
#: Line breaks. hard: a blank line, or a break no wrapping makes; listed: the line is one of a list; fits: the next word would have fitted on the line.
LINE = _table(
    _rule(True, r"", r"", "hard"),
    _rule(True, r"", r"[{=<&]"),
    _rule(True, r"", r"", "listed"),
    _rule(True, r"", r"[-*•‣◦▪]\s"),
    _rule(False, r"", r"", "inside"),
    _rule(False, rf"{_CLOSED}\s*", r""),  # decided behind the mark
    _rule(True, r"", rf"[^\S\n]*(?:{EMOJI}[^\S\n]*)+(?:\n|\Z)"),
    _rule(False, r"", rf"{EMOJI}", "!fits"),
    _rule(False, r"", r"", "!fits", "narrow"),
    _rule(False, r"", r"\s*\p{Ll}", "narrow", "!small"),
    _rule(False, r"", r"\s*\p{Ll}", "!narrow", "!small_next"),
    _rule(True, r"", r""),
)
#: Spaces between Thai letters: none behind titles and before what belongs to a date.
THAI = _table(
    _rule(False, r"", r"", "inside"),
    _rule(False, r"คุณ|นาย|นาง|นางสาว|ดร\.", r""),
    _rule(False, r"", r"\s*เป็นต้นไป"),
    _rule(True, r"", r""),
)
#: Behind emoji. opens: they open their line; ended: the line before has its end.
AFTER_EMOJI = _table(
    _rule(False, r"", r"", "inside"),
    _rule(True, r"", r"\s*\n", "opens"),
    _rule(False, r"", r"", "opens", "ended"),
    _rule(True, r"", rf"\s*(?:{START}|\Z|[-–*•]\s)"),
    _rule(True, r"", r"\s+\p{L}", "small"),
)
GREEK = _table(
    _rule(False, r"", r"\s+\p{Ll}"),
    _rule(True, r"", r"\s*\Z|\s+\S|\p{Lu}"),
)
#: Behind a quotation or bracket (bracket) that ends with a mark. begins: it stands where a sentence can begin.
QUOTE = _table(
    _rule(False, r"", rf"\s*{END}|\s*[,;:–—-]"),
    _rule(True, r"", r"", "bracket", "begins", "small_mark"),
    _rule(False, r"", r"\s*\p{Ll}", "bracket"),
    _rule(True, r"", r"", "bracket", "begins"),
    _rule(False, r"", r"", "bracket"),
    _rule(False, r"", r"\p{L}"),
    _rule(True, r"", r"\s*(?:[\"“„«‹「『(¿¡]*[\p{Lu}\p{N}]|[“„«‹「『(¿¡]|\Z)"),
    _rule(True, r"", r"\s*[\n\r]\s*[-*•]\s"),
)
_BEGINS = re.compile(rf"(?<=(?:^|\A|{END}|;|{EMOJI}|[\n\r)”»]|\p{{Thai}})\s{{0,3}})", re.M)
_LINE_ENDED = re.compile(rf"(?<=(?:\A|(?:{END}|;)[\"”’»」』)\]）]*)\s*)")

_SCRIPTS = (("latin", r"\p{Latin}"), ("cyrillic", r"\p{Cyrillic}"), ("greek", r"\p{Greek}"), ("devanagari", r"\p{Devanagari}"), ("arabic", r"\p{Arabic}"), ("thai", r"\p{Thai}"), ("hangul", r"\p{Hangul}"), ("han", r"[\p{Han}\p{Hiragana}\p{Katakana}]"))
#: The script of the last letter before a place, no more than 12 characters back.
_SCRIPT = re.compile("(?<=(?:" + "|".join(f"(?P<{n}>{p})" for n, p in _SCRIPTS) + r")[^\p{L}]{0,11})")
_WORD = re.compile(r"\s*\K\S*")
_PLACE = re.compile(rf"(?P<end>{END}+)|(?P<emoji>(?:{EMOJI}\s?)*{EMOJI})|(?P<greek>(?<=[\p{{Greek}}\)]);)|(?P<line>[^\S\n\r  ]*(?:\r\n|[\n\r  \x85\v\f])\s*)|(?P<thai>(?<=[\p{{Thai}}])[  ]+(?=[\p{{Thai}}\p{{Lu}}(]))")
_MARK = re.compile(r"[-*•‣◦▪]\s")
_NEWLINES = re.compile(r"\r\n|[\n\r  \x85\v\f]")
_QUOTES = {"“": "”", "«": "»", "‹": "›", "「": "」", "『": "』", "(": ")", "[": "]", "（": "）"}
_TRAIL = re.compile(rf"[\"”’»›」』)\]）]*(?:[^\S\n\r]?{EMOJI})*")


def _spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, opening mark) of the outermost quotations and brackets."""
    out, i, gap, n = [], 0, 0, len(text)
    for m in re.finditer(r"[“„«‹「『(\[（”\"]", text):
        at, mark = m.start(), m.group()
        if at < i:
            continue
        if mark == "”" or mark == '"':
            close = (mark,)
        elif mark == "„":
            close = ("“", "”")
        else:
            close = (_QUOTES[mark],)
        # What isn't closed before the next blank line is a stray mark.
        if gap <= at:
            gap = blank if (blank := text.find("\n\n", at)) >= 0 else n
        ends = [e for c in close if (e := text.find(c, at + 1, gap)) >= 0]
        if not ends:
            continue
        end = min(ends) + 1
        out.append((at, end, mark))
        i = end
    return out


class Lines:
    """The lines of a text: where they begin and end, and how wide their paragraphs are."""

    def __init__(self, text: str):
        self.text = text
        breaks = [m.span() for m in _NEWLINES.finditer(text)]
        self.starts, self.ends = [0] + [e for _, e in breaks], [s for s, _ in breaks] + [len(text)]
        self._small: dict[int, bool] = {}
        self._widths: list[int] | None = None

    def at(self, place: int) -> int:
        return bisect_right(self.starts, place) - 1

    def small(self, line: int) -> bool:
        """Whether a line of some length has small letters only."""
        if line not in self._small:
            part = self.text[self.starts[line] : self.ends[line]]
            self._small[line] = not any(map(str.isupper, part)) and sum(map(str.islower, part)) >= 12
        return self._small[line]

    def width(self, line: int) -> int:
        """Width of a line's paragraph: its longest line that is no list line."""
        if self._widths is None:
            self._widths, para, width = [0] * len(self.starts), [], 0
            for i, (s, e) in enumerate([*zip(self.starts, self.ends), (0, 0)]):
                part = self.text[s:e].rstrip()
                if part.strip():
                    para.append(i)
                    width = width if _MARK.match(part.lstrip()) else max(width, len(part))
                else:
                    for j in para:
                        self._widths[j] = width
                    para, width = [], 0
        return self._widths[line]


def decide(table: Table, text: str, before: int, after: int, facts: set[str]) -> bool | None:
    """What the first rule of a table says that holds for the text up to ``before`` and from ``after`` on; None if none does."""
    if table.before is not None and table.before.match(text, before) is None:
        return None
    for breaks, b, a, needs, bars in table.rules:
        if needs <= facts and not bars & facts and (a is None or a.match(text, after)) and (b is None or b.match(text, before)):
            return breaks
    return None


def boundaries(text: str) -> list[int]:
    """Places (offsets) at which a new sentence may begin."""
    spans = _spans(text)
    starts = [s for s, _, _ in spans]
    opening = set(starts)
    lines = Lines(text)
    out: set[int] = set()
    pos = 0
    while (m := _PLACE.search(text, pos)) is not None:
        begin, at = m.span()
        pos = max(at, pos + 1)
        i = bisect_right(starts, begin) - 1
        span = spans[i] if i >= 0 and spans[i][0] < begin < spans[i][1] else None
        facts = {"inside"} if span is not None else set()
        kind, line = m.lastgroup, lines.at(begin)
        before = after = place = at
        if kind == "line":
            before, here = begin, text[lines.starts[line] : begin]
            width, word = lines.width(line), _WORD.match(text, at)
            if len(_NEWLINES.findall(m.group())) >= 2 or " " in m.group() or m.group()[0] in " \t\u3000\xa0":
                facts.add("hard")  # wrapping leaves no space at the end of a line
            facts |= {f for f, x in (("listed", _MARK.match(here.lstrip())), ("fits", len(here.rstrip()) + 1 + len(word.group()) <= width), ("narrow", width <= WRAP_LIMIT), ("small", lines.small(line)), ("small_next", lines.small(lines.at(at)))) if x}
            cascade = (LINE,)
        elif kind == "thai":
            before, cascade = begin, (THAI,)
        elif kind == "emoji":
            start = lines.starts[line]
            if not text[start:begin].strip():
                facts |= {"opens"} | ({"ended"} if start and _LINE_ENDED.match(text, start) else set())
            facts |= {"small"} if lines.small(line) else set()
            cascade = (AFTER_EMOJI,)
        elif span is not None:
            s, e, mark = span
            # A whole quotation or bracket ends here only if nothing but closing marks follows in it.
            if e <= at or text[at:e].strip("\"”’“»›」』)］） "):
                continue
            place = after = before = _TRAIL.match(text, e).end()
            facts = {f for f, x in (("bracket", mark in "([（"), ("begins", _BEGINS.match(text, s)), ("small_mark", lines.small(lines.at(s)))) if x}
            cascade = (QUOTE,)
        else:
            place = _TRAIL.match(text, at).end()
            if place > at and text[at] in "\"”" and at in opening:
                place = at  # an opening mark of the next sentence
            after = place
            facts = {"small"} if lines.small(line) else set()
            if kind == "greek":
                cascade = (GREEK,)
            elif m.group() == ".":
                script = _SCRIPT.match(text, at)
                cascade = (NO_BREAK, *((TABLES[script.lastgroup],) if script and script.lastgroup in TABLES else ()), BREAK)
            else:
                cascade = (BREAK,)
        if next((x for t in cascade if (x := decide(t, text, before, after, facts)) is not None), False):
            out.add(place)
    return sorted(out)


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) in code points of each sentence, without the white space round it."""
    if not text or not text.strip():
        return []
    out, a = [], 0
    for b in [*boundaries(text), len(text)]:
        piece = text[a:b]
        if piece.strip():
            s = a + len(piece) - len(piece.lstrip())
            out.append((s, a + len(piece.rstrip())))
        a = b
    return out


def split(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start_char, end_char), a row per sentence. Null and blank texts have none; a repeated key repeats its rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, s, e) for k, t in zip(pdf["k"], pdf["t"]) for s, e in sentences(t)]
            yield pd.DataFrame(rows, columns=["k", "start_char", "end_char"]).astype({"start_char": "int32", "end_char": "int32"})

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, start_char int, end_char int")
    return out.withColumnRenamed("k", key)
