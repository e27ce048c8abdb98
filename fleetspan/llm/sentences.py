"""Sentence units across languages and scripts.

The boundary rules are compiled into one finite transducer over character symbols. What needs more than a character to
tell is marked first and reaches the transducer as a symbol of its own: the class of the word before a full stop (an abbreviation that goes
on, that goes on before a number, that may close the sentence; an initial; an ordinal), list markers, blank lines, and quotation marks without a partner. A text is cut into blocks of equal length; a block is a function from states to states, all blocks are
computed in step, composed by a parallel prefix scan, and run once more from their now known first states to read the
boundaries off. A long document is therefore no slower than many short ones.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 256
BATCH_CHARS = 2_000_000

SYMBOLS = "oth low upp cls han kana quot thai dig ws para ta tc ell ell2 abm abn dq oq cq deo go gc jo jc op cp dash com".split()
SYM = {name: i for i, name in enumerate(SYMBOLS)}
QUOTES = {"dq": ("dq", ("dq",)), "cur": ("oq", ("cq",)), "de": ("deo", ("oq", "cq")), "guil": ("go", ("gc",)), "cor": ("jo", ("jc",))}
STATES = ["beg", "txt", "trm", "trmc", "trm_w", "ell", "ellc", "ell_w", "abm", "abm_w", "abm_op", "abn", "abn_w", "clt", "clt_j", "clt_w", "dsh", "tha", "tha_w"]
STATES += [f"{q}_{x}" for q in QUOTES for x in ("txt", "trm")]
STATE = {name: i for i, name in enumerate(STATES)}
#: A unit may end after the character that leads into one of these.
PENDING = ("trm", "trmc", "ell", "ellc", "abm", "abn", "clt", "clt_j", "tha")

# Abbreviations after which a sentence goes on, whatever follows.
GO_ON = (
    "Sr Sra Srs Sras Srta Dr Dra Drs Dras Prof Profa Profs Eng Enga Arq Lic Ing Mr Mrs Ms Mme Mlle Hr Fr Hrn Frl Rev Hon Gov Sen Rep Gen Cel Cap Ten Sgt Maj Mal Pe Exmo Exma Ilmo "
    "Av Avda Al Pça Rod Trav Tv Estr Ctra Jd Vl Pq Str Bd bd av pl ch Nr núm num pág págs pag p pp art arts inc par cap caps sec vol vols fig figs tab tabs Abb Tab Fig Vol Art Cf cf vgl Vgl "
    "Col Lt Capt Cpt Adm Brig Dept Depts Approx Ave Blvd Mt vs Messrs np tzn tj ul godz św inż mgr prof bijv dhr mevr blz bzgl "
    "vel máx mín aprox approx ca env incl inkl excl zzgl bzw evtl ggf vs tel fone ref ed trad obs Obs ex ej Ex EE"
).split()
# Abbreviations that may also close a sentence; it ends there if a new one seems to begin.
MAY_END = "itd itp enz etc usw min mins Min seg sec hr hrs h km Std Ltda Ltd Inc Corp Co Cia Jr St dept UU".split()
# Months and periods that follow a German ordinal.
AFTER_ORDINAL = "Januar Februar März April Mai Juni Juli August September Oktober November Dezember Halbjahr Quartal Jahrhundert Etage Stock Klasse Linie".split()

NL = r"(?>\r\n|[\n\r\x0b\x0c\x85 ])"
NEW_LINE = re.compile(NL)
BLANK_LINE = re.compile(rf"(?:{NL}[^\S\r\n\x0b\x0c\x85 ]*){{2,}}| ")
ITEM = re.compile(r"(?m)^[^\S\r\n]*(?:([-*•‣◦▪])|(\d{1,3})[.)]|[a-z]\))[^\S\r\n]+(?=\S)")
DOTS = re.compile(r"\.{2,}|…{2,}")
_alt = lambda words: "|".join(sorted(map(re.escape, words), key=len, reverse=True))
NUMBERED = frozenset("Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec No no Nos nos N n Sec sec Pt pt Ch ch Para para Cl cl Rev rev".split())  # go on before a number
WITH_DIGNITY = frozenset(["डॉ", "श्री", "प्रो", "सु"])
PAIRS = {"e": "i", "g": "e", "B": "z", "h": "d", "a": "u", "ä": "o", "ex": "p", "ej": "p"}  # second part of an abbreviation of two -> first
GO_ON_WORDS, ORDINALS = frozenset(GO_ON), tuple(AFTER_ORDINAL)
BEFORE_ORDINAL = re.compile(r"\b(?:[IiAa]m|[VvZz][ou]m|de[rnms]) $")
LONGEST = max(map(len, GO_ON))
#: An end mark that the next sentence follows without a blank: a capital, or a number of up to 31 signs that leads into Han or kana
#: (a bound, so that a long run of digits and points is not read again from each of its points).
TIGHT = re.compile(
    r"[.!?](?:(?<=[^\W\d_]{2}[.!?])|(?<=[^\w\s.,;:/@#-][.!?]))(?=[A-ZÀ-ÝＡ-Ｚ]|[0-9][\w.:．-]{0,30}[\u3040-\u30ff\u3400-\u9fff])"
    r"|[)\]](?<=[.!?][)\]])(?=[A-ZÀ-Ý])"
)
ENDING = re.compile(rf"(?<![\w])(?:(?:{_alt(MAY_END)})\.|(?:[A-ZÀ-ÖØ-Þ]\.\s?){{2,}}(?<!\s)(?=\s|$|[^\w\s])|(?:[a-zß-ÿ]{{1,2}}\.){{2,}}(?=\s|$|[^\w\s])|[ap]\.\s?m\.)")


@lru_cache(maxsize=1)
def char_symbols() -> np.ndarray:
    """Symbol of each code point when nothing around it matters."""
    out = np.zeros(0x110000, dtype=np.uint8)
    for cp in range(0x30000):
        ch = chr(cp)
        kind = unicodedata.category(ch)
        if ch.isspace():
            out[cp] = SYM["ws"]
        elif kind == "Ll":
            out[cp] = SYM["low"]
        elif kind in ("Lu", "Lt"):
            out[cp] = SYM["upp"]
        elif kind == "Nd":
            out[cp] = SYM["dig"]
        elif kind in ("Lo", "Lm", "Mn", "Mc"):
            out[cp] = SYM["cls"]
    out[[0xAA, 0xBA]] = SYM["low"]  # ordinal signs
    for lo, hi, name in ((0x3400, 0x9FFF, "han"), (0xF900, 0xFAFF, "han"), (0x20000, 0x2FFFF, "han"), (0x3040, 0x30FF, "kana"), (0x31F0, 0x31FF, "kana"), (0xFF66, 0xFF9F, "kana"), (0x0E00, 0x0EFF, "thai")):
        out[lo : hi + 1] = SYM[name]
    for chars, name in (
        ("とっをがにへ", "quot"), (".!?؟．", "ta"), ("。！？｡।॥۔", "tc"), ("…", "ell"), ('"＂', "dq"), ("“", "oq"), ("”", "cq"), ("„", "deo"), ("«", "go"), ("»", "gc"), ("「『", "jo"), ("」』", "jc"),
        ("([{（［【¿¡", "op"), (")]}）］】", "cp"), ("–—―", "dash"), (",;:،؛，；：、", "com"), (" ", "para"),
    ):
        for ch in chars:
            out[ord(ch)] = SYM[name]
    return out


@lru_cache(maxsize=1)
def transducer() -> tuple[np.ndarray, np.ndarray]:
    """``next[state, symbol]``, and ``ends[state, symbol]``: whether the pending end is confirmed when the symbol is read."""
    nxt = np.zeros((len(STATES), len(SYMBOLS)), dtype=np.uint8)
    ends = np.zeros((len(STATES), len(SYMBOLS)), dtype=bool)
    fresh = {s: "txt" for s in SYMBOLS}  # what a symbol leads to in running text
    fresh |= {"ta": "trm", "tc": "trmc", "ell": "ell", "ell2": "ellc", "abm": "abm", "abn": "abn", "thai": "tha", "para": "beg"}
    fresh |= {begin: f"{q}_txt" for q, (begin, _) in QUOTES.items()}
    openers = {begin for begin, _ in QUOTES.values()} - {"dq"}
    closers = {"cp", "cq", "gc", "jc"}
    words = {"oth", "low", "upp", "cls", "han", "kana", "quot", "thai", "dig"}

    def rule(state: str, symbols, to: str | None = None, end: bool = False) -> None:
        for s in [symbols] if isinstance(symbols, str) else symbols:
            nxt[STATE[state], SYM[s]] = STATE[to or fresh[s]]
            ends[STATE[state], SYM[s]] = end

    for state in STATES:
        rule(state, SYMBOLS)
        rule(state, "para", "beg", True)
    rule("beg", "ws", "beg")
    # after an end mark
    for state in ("trm", "trmc"):
        rule(state, closers | {"dq"}, state)
        rule(state, {"ta", "ell", "ell2", "abm", "abn"}, state)
        rule(state, "tc", "trmc")
        rule(state, "ws", "trm_w")
        rule(state, openers, end=True)
    rule("trm", words | {"com", "dash", "op"}, "txt")
    rule("trm", {"han", "kana", "quot", "thai", "cls"}, end=True)
    rule("trmc", words | {"dash", "op"}, end=True)
    rule("trm_w", set(SYMBOLS) - {"ws", "para"}, end=True)
    rule("trm_w", "ws", "trm_w")
    rule("trm_w", {"ta", "tc", "ell", "ell2", "abm", "abn"} | closers, "trm")
    rule("trm_w", "dash", "dsh")
    # a dash after an end mark: a lower-case word goes on with the sentence
    rule("dsh", set(SYMBOLS) - {"ws", "para", "low"}, end=True)
    rule("dsh", {"ws", "dash"}, "dsh")
    rule("dsh", "low", "txt")
    # ellipsis
    for state in ("ell", "ellc"):
        rule(state, closers | {"dq"}, state)
        rule(state, "ell", "ell")
        rule(state, "ws", "ell_w")
        rule(state, openers, end=True)
    rule("ell", words | {"com", "dash", "op"}, "txt")
    rule("ell", {"han", "upp"}, end=True)
    rule("ellc", {"han", "upp", "dig", "cls", "thai", "op"}, end=True)
    rule("ellc", {"ell", "ell2"}, "ellc")
    rule("ell_w", set(SYMBOLS) - {"ws", "para", "low", "com"}, end=True)
    rule("ell_w", "ws", "ell_w")
    rule("ell_w", {"low", "com"}, "txt")
    rule("ell_w", closers, "ell")
    rule("ell_w", "dash", "dsh")
    # an abbreviation that goes on before a number, and is an end mark before all else
    for s in SYMBOLS:
        for own, like in (("abn", "trm"), ("abn_w", "trm_w")):
            to, end = int(nxt[STATE[like], SYM[s]]), bool(ends[STATE[like], SYM[s]])
            nxt[STATE[own], SYM[s]], ends[STATE[own], SYM[s]] = to, end
    rule("abn", "ws", "abn_w")
    rule("abn_w", "ws", "abn_w")
    rule("abn", "dig", "txt")
    rule("abn_w", "dig", "txt")
    # an abbreviation that may close the sentence
    rule("abm", closers | {"dq"}, "abm")
    rule("abm", "ws", "abm_w")
    rule("abm", "upp", end=True)
    rule("abm_w", "ws", "abm_w")
    rule("abm_w", {"upp", "dig", "oth", "dq"} | openers, end=True)
    rule("abm_w", {"low", "cls", "han", "kana", "quot", "com"}, "txt")
    rule("abm_w", "dash", "dsh")
    rule("abm_w", "op", "abm_op")
    rule("abm_op", set(SYMBOLS) - {"para", "low", "ws"}, end=True)
    rule("abm_op", "low", "txt")
    # a quotation that ended with an end mark
    for state in ("clt", "clt_j"):
        rule(state, closers, state)
        rule(state, "ws", "clt_w")
        rule(state, openers, end=True)
        rule(state, words | {"com", "dash"}, "txt")
    rule("clt", {"upp", "dig"}, end=True)
    rule("clt_j", {"oth", "low", "upp", "cls", "han", "kana", "dig", "thai", "op"}, end=True)
    rule("clt_w", set(SYMBOLS) - {"ws", "para", "low", "cls", "com", "ta", "tc"}, end=True)
    rule("clt_w", "ws", "clt_w")
    rule("clt_w", {"low", "cls", "com"}, "txt")
    rule("clt_w", closers, "clt")
    rule("clt_w", "dash", "dsh")
    # a script without sentence marks: white space separates
    rule("tha", {"dig", "oth", "cls", "com"}, "tha")
    rule("tha", "ws", "tha_w")
    rule("tha_w", set(SYMBOLS) - {"ws", "para", "com", "ta", "tc", "ell", "ell2", "abm", "abn"} - closers, end=True)
    rule("tha_w", "ws", "tha_w")
    rule("tha_w", closers, "tha")
    # inside quotation marks nothing ends but at a blank line
    for q, (_, close) in QUOTES.items():
        plain, marked = f"{q}_txt", f"{q}_trm"
        for state in (plain, marked):
            rule(state, set(SYMBOLS) - {"para"}, plain)
            rule(state, {"ta", "tc", "ell", "ell2", "abm", "abn"}, marked)
        rule(marked, "ws", marked)
        rule(plain, close, "txt")
        rule(marked, close, "clt_j" if q == "cor" else "clt")
    return nxt, ends


def word_classes(text: str, cp: np.ndarray, kind: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Full stops by the class of the word before them: those after which a sentence goes on, and those after which it goes on before a number.

    Only words before full stops are looked at, in sets. ``solid``: places of what is no white space, so that any number of blanks may follow.
    """
    word = ((kind >= SYM["low"]) & (kind <= SYM["dig"])) | (cp == 95)
    dots = np.flatnonzero(cp == 46)
    dots = dots[dots > 0]
    begin = np.maximum.accumulate(np.where(word, -1, np.arange(len(cp))))[dots - 1] + 1
    size = dots - begin
    short = (size > 0) & (size <= LONGEST)
    follows = np.append(solid, len(cp))[np.searchsorted(solid, dots + 1)]
    on: list[int] = []
    numbered: list[int] = []
    for i, dot, then in zip(begin[short].tolist(), dots[short].tolist(), follows[short].tolist(), strict=True):
        w, before = text[i:dot], text[i - 1 : i]
        if w in GO_ON_WORDS or w in WITH_DIGNITY:
            on.append(dot)
        elif w in NUMBERED:
            numbered.append(dot)
        elif w in PAIRS and text[max(0, i - 3) : i].rstrip().endswith(PAIRS[w] + ".") and not text[max(0, i - 4) : i].rstrip()[:-2][-1:].isalnum():
            on += [dot, text.rindex(".", 0, i)]
        elif len(w) == 1 and ((w.isupper() and before != "." and (text[dot + 1 : dot + 2].isspace() or text[dot + 1 : dot + 2] == "-")) or "ء" <= w <= "ي"):
            on.append(dot)
        elif len(w) <= 2 and w.isdigit() and before not in (".", ",") and then > dot + 1 and (text.startswith(ORDINALS, then) or BEFORE_ORDINAL.search(text, max(0, i - 4), i)):
            on.append(dot)
    return np.array(on, dtype=np.int64), np.array(numbered, dtype=np.int64)


IS_QUOTE = np.isin(np.arange(len(SYMBOLS)), [SYM[x] for o, closes in QUOTES.values() for x in (o, *closes)])
OPENS = {SYM[o]: tuple(SYM[c] for c in closes) for o, closes in QUOTES.values()}


def lone_quotes(sym: np.ndarray) -> np.ndarray:
    """Places of opening quotation marks that nothing closes before the next blank line, and of straight ones without a partner.

    A straight mark after a blank and before text can only open, one before a blank can only close; a mark that can only open while
    one is open makes that one a stray. What is inside a quotation does not open another.
    """
    at = np.flatnonzero(IS_QUOTE[sym])
    if not len(at):
        return at
    part = np.searchsorted(np.flatnonzero(sym == SYM["para"]), at)
    kind = sym[at]
    blank = (sym == SYM["ws"]) | (sym == SYM["para"])
    before = np.where(at > 0, blank[at - 1], True)
    after = np.where(at + 1 < len(sym), blank[np.minimum(at + 1, len(sym) - 1)], True)
    # paragraphs whose marks pair off need no look
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    n = {k: np.add.reduceat((kind == SYM[k]).astype(np.int64), first) for k in ("dq", "oq", "cq", "deo", "go", "gc", "jo", "jc")}
    one_way = np.add.reduceat(((kind == SYM["dq"]).astype(np.int64)) * (before.astype(np.int64) - after), first)
    low, high = np.minimum(n["oq"], n["cq"] + n["deo"]), np.maximum(n["oq"], n["cq"] + n["deo"])
    pairs = (n["dq"] % 2 == 0) & (one_way == 0) & (n["go"] == n["gc"]) & (n["jo"] == n["jc"]) & (low == high) & ((n["cq"] == 0) | (n["deo"] == 0))
    look = np.repeat(~pairs, np.diff(np.append(first, len(at))))
    at, part, kind, before, after = at[look], part[look], kind[look], before[look], after[look]
    last: dict[tuple[int, int], int] = {}
    for p, k, x in zip(part.tolist(), kind.tolist(), at.tolist(), strict=True):
        last[p, k] = x  # the last of its kind in the paragraph
    stray: list[int] = []
    straight, opened, inside = SYM["dq"], -1, -1
    for x, k, p, b, a in zip(at.tolist(), kind.tolist(), part.tolist(), before.tolist(), after.tolist(), strict=True):
        if opened >= 0 and p != inside:
            stray.append(opened)
            opened = -1
        if opened >= 0:
            if k in OPENS[int(sym[opened])]:
                if k == straight and b and not a:  # it can only open
                    stray.append(opened)
                    opened = x
                else:
                    opened = -1
        elif k in OPENS and not (k == straight and a and not b):
            if any(last.get((p, c), -1) > x for c in OPENS[k]):
                opened, inside = x, p
            else:
                stray.append(x)
        elif k == straight:
            stray.append(x)
    if opened >= 0:
        stray.append(opened)
    return np.array(stray, dtype=np.int64)


def symbols_of(text: str, cp: np.ndarray) -> np.ndarray:
    """Symbols of a text, with the patterns applied."""
    kind = char_symbols()[cp]
    sym = kind.copy()
    for m in DOTS.finditer(text):
        sym[m.start() : m.end()] = SYM["ell"] if text[m.start()] == "." else SYM["ell2"]
    for m in TIGHT.finditer(text):
        sym[m.start()] = SYM["tc"]
    for m in ENDING.finditer(text):
        a, b = m.span()
        part = sym[a:b]
        part[part == SYM["ta"]] = SYM["oth"]
        sym[b - 1] = SYM["abm"]
    solid = np.flatnonzero(kind != SYM["ws"])
    for at, name in zip(word_classes(text, cp, kind, solid), ("oth", "abn"), strict=True):
        at = at[np.isin(sym[at], (SYM["ta"], SYM["tc"], SYM["abm"]))]
        sym[at] = SYM[name]
    for m in BLANK_LINE.finditer(text):
        sym[m.start()] = SYM["para"]
    found = [(*m.span(), int(m.group(2)) if m.group(2) else None) for m in ITEM.finditer(text)]
    last, last_at = None, -1
    for k, (a, b, number) in enumerate(found):
        if number is not None and number != 1:
            before = int(np.searchsorted(solid, a)) - 1
            gap = text[solid[before] + 1 : a] if before >= 0 else None
            after_blank = gap is None or len(NEW_LINE.findall(gap)) > 1
            after_one = last == number - 1 and not BLANK_LINE.search(text, last_at, a)
            before_one = k + 1 < len(found) and found[k + 1][2] == number + 1 and not BLANK_LINE.search(text, b, found[k + 1][0])
            if not (after_blank or after_one or before_one):
                continue
        if a and sym[a - 1] == SYM["ws"]:
            sym[a - 1] = SYM["para"]
        part = sym[a:b]
        part[part != SYM["ws"]] = SYM["oth"]
        last, last_at = number, b
    at = lone_quotes(sym)
    closes = (at > 0) & (sym[np.maximum(at - 1, 0)] != SYM["ws"])
    sym[at] = np.where(closes, SYM["cp"], SYM["op"])
    return sym


def states_of(sym: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """State before each symbol (and, last, after all), from ``beg``."""
    nxt, _ = transducer()
    n, wide = len(sym), len(SYMBOLS)
    count = -(-n // block)
    padded = np.full(count * block, SYM["ws"], dtype=np.uint8)
    padded[:n] = sym
    cols = np.ascontiguousarray(padded.reshape(count, block).T)
    table = nxt.astype(np.intp).ravel() * wide  # next state, ready to be added to a symbol
    # each block as a function of its first state
    fun = np.broadcast_to(np.arange(len(STATES)) * wide, (count, len(STATES))).copy()
    for row in cols:
        fun = table[fun + row[:, None]]
    fun //= wide
    # inclusive prefix scan by composition
    step = 1
    while step < count:
        later = fun[step:]
        fun = np.concatenate([fun[:step], np.take_along_axis(later, fun[:-step], axis=1)])
        step *= 2
    first = np.concatenate([[STATE["beg"]], fun[:-1, STATE["beg"]]]) * wide
    out = np.empty((block, count), dtype=np.uint8)
    for t, row in enumerate(cols):
        out[t] = first // wide
        first = table[first + row]
    flat = out.T.ravel()[:n]
    after = nxt[flat[-1], sym[-1]] if n else STATE["beg"]
    return np.concatenate([flat, [after]]).astype(np.uint8)


def units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, start, end) of every unit of every text, in order; offsets in code points."""
    gap = "\n\n"
    whole = gap.join(texts)
    if not whole.strip():
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    cp = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sym = symbols_of(whole, cp)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(size + len(gap))[:-1]])
    sym[begin[1:] - len(gap)] = SYM["para"]
    state = states_of(sym)
    _, ends = transducer()
    n = len(sym)
    confirmed = ends[state[:-1], sym]
    pending = np.isin(state[1:], [STATE[s] for s in PENDING])
    mark = np.maximum.accumulate(np.where(pending, np.arange(n), -1))
    at = np.flatnonzero(confirmed & (sym != SYM["para"]))
    cuts = np.unique(np.concatenate([[0], mark[at - 1] + 1, np.flatnonzero(sym == SYM["para"]), begin, [n]]))
    cuts = cuts[(cuts >= 0) & (cuts <= n)]
    blank = (sym == SYM["ws"]) | (sym == SYM["para"])
    solid = np.flatnonzero(~blank)
    a, b = cuts[:-1], cuts[1:]
    lo, hi = np.searchsorted(solid, a), np.searchsorted(solid, b)
    some = lo < hi
    start, end = solid[lo[some]], solid[hi[some] - 1] + 1
    doc = np.searchsorted(begin, start, side="right") - 1
    return doc, start - begin[doc], end - begin[doc]


def sentence_units(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``start_char``, ``end_char`` of every sentence unit, offsets in code points, end exclusive.

    Null, empty and blank texts have none. Rows with a null or repeated key are segmented each on its own. Texts of any length are
    processed whole. An empty input gives no rows; other columns are ignored.
    """
    rows = df.select(key, text).where(df[text].isNotNull())
    kind = dict(rows.dtypes)[key]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                to, held = at, 0
                while to < len(texts) and (to == at or held + len(texts[to]) <= BATCH_CHARS):
                    held += len(texts[to])
                    to += 1
                doc, start, end = units(texts[at:to])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc + at)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], [key, "start_char", "end_char"])
                at = to

    return rows.mapInArrow(split, f"`{key}` {kind}, start_char int, end_char int")
