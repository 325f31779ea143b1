"""Garbled text from a wrong character decoder: find it and, where the bytes survived, undo it.

A noisy channel is a pair (read, true): bytes of the encoding ``true`` were decoded as ``read``. For a
channel the characters of a token give back their bytes; the bytes are a lattice in which each place can be
kept as it stands or read, with as many bytes as it takes, as a character of the true encoding. A byte that
was lost is a wildcard, whichever byte of a character it is: one that U+FFFD or a question mark stands for, or one
that is gone without a trace, which costs LOST. Where every byte is a character, as in single-byte encodings, a
wildcard is any character. Viterbi search finds the likeliest path under a language model of the corpus itself:
counts of its words and of its character pairs. A token is damaged if the best path of some channel is likelier
than the token as it stands by ``MARGIN``; a token with U+FFFD or a C1 control character always is.

All statistics cover all values. Only distinct tokens are decoded, once each; the model holds the words and
character pairs that stand WORD_SHARE and PAIR_SHARE times per token or more, so at most 1 / WORD_SHARE words and
(mean length + 1) / PAIR_SHARE pairs, whatever the size of the data. Runs of digits count as one digit.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoin.session import checkpoint

WORD_SHARE = 1e-5
PAIR_SHARE = 1e-6
#: Log-odds by which a repaired token must be likelier: if the corpus knows the repaired word, and if not.
MARGIN, MARGIN_UNKNOWN, MARGIN_UTF8 = 2.0, 3.5, 0.5
SMOOTH, ALPHABET = 0.02, 4000
#: Log-odds of a byte that is gone without a trace.
LOST = 3.0
MEMO_LIMIT = 200_000

SINGLE = ("cp1252", "iso8859-15", "cp1250", "iso8859-2", "cp1251", "koi8-r", "cp866", "mac_roman", "cp437", "cp850", "cp1253", "cp1254", "cp874", "cp1256", "iso8859-5", "iso8859-7")
MULTI = ("gb18030", "cp932", "euc_jp", "cp949", "big5")
#: Nobody stores new text in these; as the true encoding they only count if they give a known word.
UNLIKELY = ("mac_roman", "cp437", "cp850", "iso8859-15")
READ_MULTI = ("gbk", "cp932", "cp949", "big5")

SPACE = r"[ \t\r\n\f\u000b]+"
DIGITS = r"[0-9]+([.,:][0-9]+)*"
TRIM = r"^[!-/:-?]+|[!-/:-?]+$"


def _single_table(name: str) -> list[str]:
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(name))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


_DECODE = {n: _single_table(n) for n in SINGLE}
#: C1 controls stand for their byte in every reading: decoders that leave bytes alone make them.
_ENCODE = {n: {chr(b): b for b in range(256)} | {c: b for b, c in enumerate(t)} if n == "cp1252" else {chr(b): b for b in range(160)} | {c: b for b, c in enumerate(t)} for n, t in _DECODE.items()}
_ENCODE["cp1252"] |= {c: b for b, c in enumerate(_DECODE["cp1252"])}
#: The characters beyond ASCII of a reading as their bytes, and as what another encoding makes of those.
_BYTES = {r: str.maketrans({c: chr(b) for c, b in _ENCODE[r].items() if b > 127}) for r in SINGLE}
_SWAPS = {r: [(t, str.maketrans({c: _DECODE[t][b] for c, b in _ENCODE[r].items() if b > 127 and _DECODE[t][b] != c})) for t in SINGLE if t != r] for r in SINGLE}
_UTF8 = re.compile("[\xc2-\xdf](?:[\x80-\xbf]|\ufffd|$)|[\xe0-\xef][\x80-\xbf](?:[\x80-\xbf]|\ufffd|$)|[\xf0-\xf4][\x80-\xbf]{2}")
_HIGH = re.compile("[\x80-\xff]")
_LONG = re.compile("[\x80-\xff]{4}")
_RUN = re.compile("([^\x00-\xff]+)")
_EAST = re.compile("[\u1100-\u11ff\u2e80-\uffef]")


class Model:
    """Language model of the corpus and the decoder of channels; made from two small tables."""

    def __init__(self, words: dict[str, int], pairs: dict[str, int], total: int):
        self.raw = (words, pairs, total)
        self.counts = pairs
        self.total = max(1, total)
        self.words = {w: math.log(n / self.total) for w, n in words.items()}
        first: Counter = Counter()
        for p, n in pairs.items():
            first[p[0]] += n
        self.first = first
        self.floor = {a: math.log(SMOOTH) - math.log(n + SMOOTH * ALPHABET) for a, n in first.items()}
        self.none = -math.log(ALPHABET)
        self.pairs = {p: math.log(n + SMOOTH) - math.log(first[p[0]] + SMOOTH * ALPHABET) for p, n in pairs.items()}
        after: dict[str, list] = {}
        for p in pairs:
            if p[1] > "\x7f" and p[1] != "�":
                after.setdefault(p[0], []).append(p[1])
        self.after = after
        self._sequences: dict[str, tuple[dict, dict]] = {}
        self.memo: dict[str, str] = {}
        #: The reading under which a path through UTF-8 was found, of the token at hand.
        self.via: dict[str, str] = {}

    def step(self, a: str, b: str) -> float:
        got = self.pairs.get(a + b)
        return got if got is not None else self.floor.get(a, self.none)

    def chain(self, s: str) -> float:
        pairs, floor, none, score, a = self.pairs, self.floor, self.none, 0.0, "\x02"
        for b in s + "\x03":
            got = pairs.get(a + b)
            score += got if got is not None else floor.get(a, none)
            a = b
        return score

    def score(self, s: str) -> float:
        word = self.words.get(s)
        chain = self.chain(s)
        return chain if word is None or word < chain else word

    def sequences(self, true: str) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
        """(whole, torn): the corpus' characters by their bytes in an encoding, and by their bytes with one of them lost (\x00)."""
        if true not in self._sequences:
            whole: dict[str, list[str]] = {}
            torn: dict[str, list[str]] = {}
            for c in self.first:
                if c > "\x7f" and c != "�":
                    try:
                        raw = c.encode(true).decode("latin-1")
                    except UnicodeEncodeError:
                        continue
                    if len(raw) > 1:
                        whole.setdefault(raw, []).append(c)
                        for j in range(len(raw)):
                            torn.setdefault(raw[:j] + "\x00" + raw[j + 1 :], []).append(c)
            self._sequences[true] = whole, torn
        return self._sequences[true]

    def lattice(self, s: str, got: str, true: str, torn_too: bool = False) -> list[str]:
        """Likeliest path, and the path of all whole sequences, where characters of s (``got``: their bytes) may be bytes of the encoding ``true``.

        Each place is kept, or read with the bytes behind it as a character; one byte of it can be lost, at any place.
        Bytes gone without a trace are only tried at the token's end, or everywhere with ``torn_too``.
        """
        whole, torn = self.sequences(true)
        n, high = len(s), [c > "\x7f" or c == "?" for c in got]
        edges: list[list[tuple[int, str, float]]] = [[] for _ in range(n)]
        any_edge, marked, utf8 = False, "�" in got or "?" in got, true == "utf-8"
        for i in range(n):
            if not high[i] or (utf8 and not marked and not torn_too and not "\xc2" <= got[i] <= "\xf4"):
                continue
            for size in (2, 3, 4):
                part = got[i : i + size]
                if len(part) == size:
                    if part in whole:
                        edges[i] += [(size, c, 0.0) for c in whole[part]]
                    marks = [j for j, c in enumerate(part) if c in "�?"] if marked else ()
                    if len(marks) == 1:
                        j = marks[0]
                        edges[i] += [(size, c, 0.0) for c in torn.get(part[:j] + "\x00" + part[j + 1 :], ())]
                # A byte gone without a trace: something must be left that shows the rest was a sequence.
                if not torn_too and (i + size - 1 != n or not utf8):
                    continue
                short = got[i : i + size - 1]
                if len(short) == size - 1 and short[0] > "\x7f" and "�" not in short and (size > 2 or not utf8 or "\xc2" <= short <= "\xdf"):
                    for j in range(size) if torn_too else (size - 1,):
                        edges[i] += [(size - 1, c, LOST if torn_too else LOST / 2) for c in torn.get(short[:j] + "\x00" + short[j:], ())]
            any_edge |= bool(edges[i])
        if not any_edge:
            return []
        best: list[dict[str, tuple[float, str]]] = [{} for _ in range(n + 1)]
        best[0]["\x02"] = (0.0, "")
        pairs, floor, none = self.pairs, self.floor, self.none
        for i in range(n):
            ways = [(1, s[i], 0.0), *edges[i]]
            for a, (score, path) in best[i].items():
                least = floor.get(a, none)
                for width, c, cost in ways:
                    total = score + pairs.get(a + c, least) - cost
                    ends = best[i + width]
                    if c not in ends or total > ends[c][0]:
                        ends[c] = (total, path + c)
        out, i = [], 0
        while i < n:
            width, c = next(((w, x) for w, x, cost in edges[i] if not cost and "�" not in s[i : i + w]), (1, s[i]))
            out.append(c)
            i += width
        return [max((score + self.step(a, "\x03"), path) for a, (score, path) in best[n].items())[1], "".join(out)]

    def rarest(self, s: str) -> tuple[int, int]:
        """Place and count of the rarest pair with a character beyond ASCII, in the token between its marks."""
        counts, padded, best = self.counts, "\x02" + s + "\x03", (1 << 62, 0)
        for i in range(len(padded) - 1):
            if padded[i] > "\x7f" or padded[i + 1] > "\x7f":
                best = min(best, (counts.get(padded[i : i + 2], 0), i))
        return best[1], best[0]

    def candidates(self, s: str, torn_too: bool = False, reads: tuple[str, ...] = SINGLE, multi: tuple[str, ...] = MULTI) -> dict[str, bool]:
        """What the channels make of a token; True for those through UTF-8, whose byte pattern is evidence by itself.

        A channel between single-byte encodings is only followed if it makes the token's rarest pair a commoner one.
        """
        first, counts = self.first, self.counts
        out: dict[str, bool] = {}
        done: set[str] = set()
        at, rare = self.rarest(s)
        wide = sum(c > "\x7f" for c in s)
        for read in reads:
            got = s.translate(_BYTES[read])
            if got in done or not _HIGH.search(got):
                continue
            done.add(got)
            if _UTF8.search(got):
                for path in self.lattice(s, got, "utf-8", torn_too):
                    out[path] = True
                    self.via.setdefault(path, read)
            if wide > 1:
                if max(got) <= "\xff":
                    raw = got.encode("latin-1")
                    for true in multi:
                        try:
                            out.setdefault(raw.decode(true), False)
                        except UnicodeDecodeError as e:
                            if e.end == len(raw) and e.start > 1:  # the last byte is lost
                                out.setdefault(raw[: e.start].decode(true) + "�", False)
                            if torn_too and len(raw) > 2:
                                for path in self.lattice(s, got, true, True):
                                    out.setdefault(path, False)
                elif _LONG.search(got):
                    for true in multi:
                        if (cand := _runs(got, true)) is not None:
                            out.setdefault(cand, False)
                        elif "�" in s:
                            for path in self.lattice(s, got, true, torn_too):
                                out.setdefault(path, False)
            for true, table in _SWAPS[read]:
                cand = s.translate(table)
                if cand != s and counts.get(("\x02" + cand + "\x03")[at : at + 2], 0) > rare and (true not in UNLIKELY or cand in self.words):
                    out.setdefault(cand, False)
        if _EAST.search(s):
            for read in READ_MULTI:
                try:
                    raw = s.encode(read)
                except UnicodeEncodeError:
                    continue
                for true in ("utf-8", *MULTI, "cp1251", "koi8-r", "cp1252"):
                    if true != read:
                        try:
                            out.setdefault(raw.decode(true), true == "utf-8")
                        except UnicodeDecodeError:
                            pass
        out.pop(s, None)
        return {x: u for x, u in out.items() if all(c <= "\x7f" or c == "�" or c in first for c in x)}

    def fill(self, s: str) -> str:
        """Replace each U+FFFD by the likeliest character; a token of which more than a third is lost stays as it is.

        All characters the corpus has behind the one before are tried, and all paths kept that end differently.
        """
        if s.count("�") * 3 > len(s) and len(s) > 2:
            return s
        beam = {"\x02": (0.0, "")}
        for c in s:
            nxt: dict[str, tuple[float, str]] = {}
            for a, (score, path) in beam.items():
                for x in self.after.get(a, ()) if c == "�" else (c,):
                    got = score + self.step(a, x)
                    if x not in nxt or got > nxt[x][0]:
                        nxt[x] = (got, path + x)
            if not nxt:
                return s
            beam = nxt
        got = max((score + self.step(a, "\x03"), path) for a, (score, path) in beam.items())[1]
        if s.count("�") == 1 and got not in self.words:  # a known word that fits is better than a likely chain
            before, after = s.split("�")
            known = [(self.words[x], x) for c in first_wide(self.first) if (x := before + c + after) in self.words]
            return max(known)[1] if known else got
        return got

    def repair(self, s: str) -> str:
        """The restored token, or the token itself if it isn't damaged."""
        if s in self.memo:
            return self.memo[s]
        now, score = s, self.score(s)
        self.via.clear()
        while True:  # each round makes the token likelier by a margin, so it ends
            cands = self.candidates(now)
            gain, best, cand = max(((self.score(x) - score - self.margin(x, u), self.score(x), x) for x, u in cands.items()), default=(-1.0, 0.0, now))
            if gain <= 0:
                # A doubly damaged token can take two steps before it is likelier.
                twice = [(self.score(y), y) for x, u in cands.items() if u for y, v in self.candidates(x).items() if v]
                best, cand = max(twice, default=(score, now))
                if best - score <= MARGIN_UTF8:
                    break
            now, score = cand, best
        if now not in self.words and (now != s or "�" in s):
            # Damaged for certain, and not a word yet: bytes may be gone, in the channel that was found.
            read = self.via.get(now)
            found = self.candidates(s, True, (read,) if read else SINGLE, MULTI if _EAST.search(now) or now == s else ())
            best = max(((self.score(x), x) for x in found), default=(score, now))
            now = best[1] if best[0] > score else now
        if "�" in now:
            now = self.fill(now)
        self.memo[s] = now
        return now

    def forget(self) -> None:
        """Bound the store of tokens already repaired; it starts anew, which changes no result."""
        if len(self.memo) > MEMO_LIMIT:
            self.memo.clear()

    def margin(self, cand: str, utf8: bool) -> float:
        return MARGIN_UTF8 if utf8 else MARGIN if cand in self.words else MARGIN_UNKNOWN

    def repair_whole(self, token: str) -> str:
        """Repair a token as it stands in a text: judged in its counted form, then done to its own characters."""
        core = fold(token)
        fixed = self.repair(core)
        if fixed == core:
            return token
        return token.replace(core, fixed, 1) if core in token else self.repair(token)


def first_wide(first: Counter) -> list[str]:
    return [c for c in first if c > "\x7f" and c != "�"]


def _runs(got: str, true: str) -> str | None:
    """Decode each run of bytes in a token that holds other characters too; None if a run doesn't decode."""
    out, hit = [], False
    for piece in _RUN.split(got):
        if piece and piece[0] <= "\xff" and not piece.isascii():
            try:
                new = piece.encode("latin-1").decode(true)
            except UnicodeError:
                return None
            hit |= len(new) < len(piece)
            piece = new
        out.append(piece)
    return "".join(out) if hit else None


_DIGITS, _TRIM = re.compile(DIGITS), re.compile(TRIM)


def fold(token: str) -> str:
    """The form in which tokens are counted: runs of digits as one digit, no ASCII punctuation at the ends."""
    return _TRIM.sub("", _DIGITS.sub("0", token))


def fold_column(token: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(token, DIGITS, "0"), TRIM, "")


def _tokens(values: DataFrame, *keep: str) -> DataFrame:
    """One row per token with a character beyond ASCII."""
    wide = values.where(F.col("text").rlike(r"[^\x00-\x7F]"))
    words = wide.select(*keep, F.explode(F.split("text", SPACE)).alias("t")).where(F.col("t").rlike(r"[^\x00-\x7F]"))
    return words.select(*keep, fold_column(F.col("t")).alias("t"))


def _count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    c: Counter = Counter()
    for pdf in batches:
        for t, n in zip(pdf["t"], pdf["n"]):
            s = "\x02" + t + "\x03"
            for i in range(len(s) - 1):
                c[s[i : i + 2]] += n
        if len(c) > 500_000:
            yield pd.DataFrame({"pair": list(c), "n": list(c.values())})
            c = Counter()
    yield pd.DataFrame({"pair": list(c), "n": list(c.values())}, columns=["pair", "n"])


def fit(tokens: DataFrame) -> Model:
    """Model of counted tokens (t, n). What the driver gets is bounded by the two shares."""
    total = tokens.agg(F.sum("n")).first()[0] or 0
    words = tokens.where(F.col("n") >= max(2, WORD_SHARE * total)).collect()
    pairs = tokens.mapInPandas(_count_pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = pairs.where(F.col("n") >= PAIR_SHARE * total).collect()
    return Model({r["t"]: r["n"] for r in words}, {r["pair"]: r["n"] for r in pairs}, total)


def damaged_tokens(tokens: DataFrame, model: Model) -> DataFrame:
    """(t, restored) of the counted tokens that are damaged."""
    shared = tokens.sparkSession.sparkContext.broadcast(model.raw)
    cls = _restore(shared)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = cls()
        for pdf in batches:
            rows = []
            for t in pdf["t"]:
                lost = any(c == "�" or ("\x80" <= c <= "\x9f" and c != "\x85") for c in t)
                fixed = m.repair(t)
                if lost or fixed != t:
                    rows.append((t, fixed))
            m.forget()
            yield pd.DataFrame(rows, columns=["t", "restored"])

    # Few bytes but much work: by bytes alone adaptive execution would make one task of it.
    n = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tokens.select("t").repartition(n, "t").mapInPandas(judge, "t string, restored string")


def _restore(shared):
    """A model made from its broadcast tables, once per task."""

    def make() -> Model:
        return Model(*shared.value)

    return make


def find_damaged(values: DataFrame, keys: list[str]) -> tuple[DataFrame, Model]:
    """values(*keys, text string) -> the keys of damaged values, each once, and the model.

    Null, empty and ASCII texts are never damaged. Texts count as often as they stand there.
    """
    counted = _tokens(values).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    counted = checkpoint(counted)
    model = fit(counted)
    bad = damaged_tokens(counted, model).select(F.xxhash64("t").alias("h"))
    rows = _tokens(values, *keys).select(*keys, F.xxhash64("t").alias("h"))
    return rows.join(bad, "h", "left_semi").select(*keys).distinct(), model


def restore_texts(values: DataFrame, model: Model) -> DataFrame:
    """Add ``restored`` to values(…, text): each damaged token repaired, the rest as it was; null stays null."""
    make = _restore(values.sparkSession.sparkContext.broadcast(model.raw))
    cut = re.compile(f"({SPACE})")

    @F.pandas_udf("string")
    def restored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = make()
        for s in batches:
            yield pd.Series([None if t is None else t if t.isascii() else "".join(x if x.isascii() else m.repair_whole(x) for x in cut.split(t)) for t in s], dtype=object)
            m.forget()

    return values.withColumn("restored", restored("text"))
