"""Secret scans: fixed patterns, and strings in sensitive contexts that a primed compressor finds new.

A candidate is a run of key characters near a sensitive word, on either side; in NAME=value the name is its context.
The two neighbours on either side of a secret, base ones included, are candidates too, so a key in lines is followed from line to
line across one line that is not new. What is assigned to a sensitive name is a candidate as a whole, with the signs in it.
A candidate that reaches beyond a base span is measured as a whole and reported beside it. Its novelty is the number of bytes it adds when the surrounding text, without its copies, is compressed by zstandard with a dictionary of identifiers, over its
length. Words and identifiers are in the dictionary or in the surrounding text and add little; random keys add
most of their length.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestep.llm.common import stored

# Fixed values of the base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
KINDS = ("assign", "access", "hex", "novel")

#: Words near which a string may be a secret.
SENSITIVE = ("key", "secret", "token", "passw", "pwd", "auth", "credential", "bearer", "private", "login", "signature", "session", "cert")
#: Identifiers every dictionary starts with.
IDENTIFIERS = ("password", "passwd", "secret", "token", "api_key", "apikey", "access_key", "access_token", "refresh_token", "client_id",
               "client_secret", "private_key", "public_key", "secret_key", "authorization", "Bearer", "credential", "username", "session_id",
               "signature", "certificate", "connection", "database", "localhost", "endpoint", "environment", "config", "default", "example",
               "placeholder", "changeme", "development", "production", "version", "timestamp", "description", "reference", "license")
#: A candidate stands at most REACH characters from a sensitive word; CONTEXT characters on either side are compressed with it.
REACH, CONTEXT = 48, 400
#: A novel string adds so many bytes for each of its characters, and so many in all. Runs shorter than an assigned value are not looked at.
MIN_NOVELTY, MIN_ADDED, MIN_LENGTH = 0.55, 7, ASSIGN_MIN
#: So many for each character of a value with signs: paths, calls and addresses are full of signs, which cost more than letters.
MIN_SIGNED = 0.75
#: Identifiers of the corpus enter the dictionary from so many documents on; most frequent first, up to so many bytes.
MIN_DOCUMENTS, DICTIONARY_BYTES = 5, 32_768

#: Runs of key characters; '=' ends one (what stands before it is a name), except as padding.
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?" % MIN_LENGTH)
#: What is assigned to a sensitive name, up to a space, its closing quote or the next part of a query string.
_ASSIGNED = re.compile(r"""(?:%s)[A-Za-z0-9_-]{0,32}["']?[ \t]*(?:=>|:=|[:=])[ \t]*(?:"([^"\s]+)"|'([^'\s]+)'|((?:(?!&[A-Za-z_]+=)\S)+))"""
                       % "|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
_CLOSING = "\"'`.,;)]}>\\"
_RULE = re.compile(r"-{2,}")
#: What may stand between two parts of one secret: line ends, quotes, signs.
_JOINT = re.compile(r"(?:[\W_]|\\[nrt]){1,%d}" % REACH)
_CONTEXT = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
_PLAIN = re.compile(r"[A-Z]?[a-z_-]+|[A-Z_-]+")
_IDENTIFIER = re.compile(r"[A-Za-z]+(?:_[A-Za-z]+)+|[A-Za-z]{4,40}(?=[=(:])")
_KEEP_HEX = bytes(104 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
#: Stands before a text that begins less than CONTEXT characters ahead of a candidate, so that zstandard weighs letters as in longer texts.
_LEAD = ("When the morning came the people of the town went down to the harbour and looked at the ships. Nobody knew how long they would stay, "
         "but there were many of them, and the men on board said that the weather had been bad for weeks. In the evening a few of the older "
         "ones told what they had seen on the other side, where the land is flat and the rivers are wide. It was late before the lights "
         "went out. See read_me_first and set_up_the_tools_by_hand, 14-03-2019, pages 26/58, or http://www.some-place.org/about/us_and_them.html. ")
_LEAD = (_LEAD * (CONTEXT // len(_LEAD) + 1))[-CONTEXT:]


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns; ``raw`` is the text in UTF-8."""
    out = []
    low = raw.lower()
    if b"pass" in low or b"secret" in low or b"token" in low or b"api" in low:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if b"AKIA" in raw:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    if b"h" * HEX_MIN in raw.translate(_KEEP_HEX):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_MIN]
    return out


def added(text: str, start: int, end: int, size) -> int:
    """Bytes that text[start:end] adds to its compressed surroundings without its copies. ``size``: bytes -> compressed length.

    The case of a word in one case says nothing, so such a string is measured in lower case.
    """
    value, low, high = text[start:end], max(0, start - CONTEXT), min(len(text), end + CONTEXT)
    first = text.find(value, max(0, low - len(value) + 1), start)  # a copy that only reaches into the surroundings goes as a whole
    if 0 <= first < low:
        low = first + len(value)
    last = text.rfind(value, end, high + len(value) - 1)
    if last >= 0 and last + len(value) > high:
        high = last
    before, after = text[low:start].replace(value, ""), text[end:high].replace(value, "")
    before = _LEAD[len(before):] + before
    if _PLAIN.fullmatch(value):
        before, value, after = before.lower(), value.lower(), after.lower()
    # Whatever stands here ends a match of the surroundings; against a line end that costs the string nothing.
    return size((before + value + after).encode()) - size((before + "\n" + after).encode())


def _candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of runs of key characters, without the dashes of rules around them."""
    out = []
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        if text.startswith("--", start):
            start = _RULE.match(text, start, end).end()
        if text.endswith("--", start, end):
            end = start + len(text[start:end].rstrip("-"))
        if end - start >= MIN_LENGTH:
            out.append((start, end))
    return out


def _in_reach(text: str, spans: list[tuple[int, int]]) -> Iterator[int]:
    """Numbers of the spans with a sensitive word in reach, before or after."""
    words = [m.span() for m in _CONTEXT.finditer(text)]
    starts, ends = [s for s, _ in words], [e for _, e in words]
    for i, (start, end) in enumerate(spans):
        before, after = bisect_right(ends, start) - 1, bisect_left(starts, end)
        if before >= 0 and starts[before] >= start - REACH or after < len(words) and ends[after] <= end + REACH:
            yield i


def _signed(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of assigned values that hold more than key characters."""
    for m in _ASSIGNED.finditer(text):
        start, end = m.span(m.lastindex)
        if m.lastindex == 3:
            end = start + len(text[start:end].rstrip(_CLOSING))
        if end - start >= MIN_LENGTH and not _CANDIDATE.fullmatch(text, start, end):
            yield start, end


def novel_spans(text: str, raw: bytes, size, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, novelty) of candidates that no base span covers."""
    low = raw.lower()
    if not taken and not any(w.encode() in low for w in SENSITIVE):
        return []
    spans = _candidates(text)
    base: list[list[int]] = []  # base spans, joined where they overlap
    for s, _, e in sorted(taken):
        if base and s < base[-1][1]:
            base[-1][1] = max(base[-1][1], e)
        else:
            base.append([s, e])
    first = [s for s, _ in base]

    def last_before(end: int) -> int:
        return bisect_left(first, end) - 1

    def covered(start: int, end: int) -> bool:
        return (j := last_before(end)) >= 0 and base[j][0] <= start and end <= base[j][1]

    inside = [covered(*span) for span in spans]
    touched = [(j := last_before(end)) >= 0 and base[j][1] > start for start, end in spans]
    near, found = set(), {}

    def new(start: int, end: int, least: float = MIN_NOVELTY) -> float | None:
        more = added(text, start, end, size)
        return None if more < MIN_ADDED or more < least * (end - start) else more / (end - start)

    open_ = sorted({*_in_reach(text, spans), *(i for i, t in enumerate(touched) if t)})
    while open_:
        i = open_.pop()
        if i in near:
            continue
        near.add(i)
        if not inside[i]:
            score = new(*spans[i])
            if score is not None:
                value = text[slice(*spans[i])]
                found[value] = max(score, found.get(value, score))
            elif not touched[i]:
                continue
        # The context holds on through the neighbours of a secret, line after line, across one that is not new.
        for step in (-1, 1):
            j = i
            while abs(j - i) < 2 and 0 <= j + step < len(spans):
                here, j = j, j + step
                if not _JOINT.fullmatch(text, spans[min(here, j)][1], spans[max(here, j)][0]):
                    break
                if j not in near:
                    open_.append(j)
    out = {span: found[text[slice(*span)]] for span, t in zip(spans, inside) if not t and text[slice(*span)] in found}
    # A longer candidate that holds a novel string is little new beside it, so the copy inside is reported.
    lengths = sorted({len(v) for v in found}, reverse=True)
    for start, end in (spans[i] for i in sorted(near) if not inside[i]):
        at = start
        while lengths and (start, end) not in out and at < end:
            held = next((n for n in lengths if at + n <= end and text[at:at + n] in found), 0)
            if held:
                out[at, at + held] = found[text[at:at + held]]
            at += held or 1
    for span in _signed(text):
        if not covered(*span) and (score := new(*span, MIN_SIGNED)) is not None:
            out[span] = score
    return [(start, 3, end, score) for (start, end), score in sorted(out.items())]


def _sizer(dictionary: bytes):
    import zstandard

    primed = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                      write_content_size=False, write_checksum=False)
    return lambda data: len(primed.compress(data))


def identifiers(docs: DataFrame, text: str = "text") -> list[str]:
    """Identifiers of the whole corpus by the number of documents that hold them, up to the size of the dictionary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for raw in batch.column(0).to_pylist():
                if raw and (b"=" in raw or b"(" in raw or b":" in raw or b"_" in raw):
                    seen.update(set(_IDENTIFIER.findall(raw.decode())))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    counted = (docs.select(F.col(text).cast("binary")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
               .filter(F.col("n") >= MIN_DOCUMENTS))
    # No identifier is shorter than three bytes, so this many fill the dictionary whatever they are.
    top = counted.orderBy(F.desc("n"), "word").limit(DICTIONARY_BYTES // 4).collect()
    out, room = [], DICTIONARY_BYTES
    for row in top:
        room -= len(row["word"].encode()) + 1
        if room < 0:
            break
        out.append(row["word"])
    return out


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", dictionary: list[str] | None = None,
         carry: list[str] | None = None) -> DataFrame:
    """Spans of secrets in each row: doc_id, spans array<struct<kind, start, end, novelty>> by start, then kind as in KINDS.

    Positions are code points of the whole text, ends exclusive; novelty is NULL for the base patterns, whose
    spans always stay. A NULL or empty text has no spans. Repeated rows each get their own row; an empty table gives an empty one. ``dictionary``:
    identifiers that prime the compressor; None counts them over these documents. ``carry``: further columns to return.
    """
    known = identifiers(docs, text) if dictionary is None else dictionary
    primer = "\n".join([*reversed(known), *IDENTIFIERS]).encode()  # what stands last is nearest to the data
    carry = list(carry or [])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("_raw"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = _sizer(primer)
        for batch in batches:
            found = []
            for raw in batch.column("_raw").to_pylist():
                if not raw:
                    found.append([])
                    continue
                content = raw.decode()
                base = base_spans(content, raw)
                spans = sorted([(s, k, e, None) for s, k, e in base] + novel_spans(content, raw, size, base), key=lambda x: x[:2])
                found.append([{"kind": KINDS[k], "start": s, "end": e, "novelty": x} for s, k, e, x in spans])
            rest = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "_raw"]
            names = [n for n in batch.schema.names if n != "_raw"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(found, kind)], [*names, "spans"])

    span = T.StructType().add("kind", "string").add("start", "long").add("end", "long").add("novelty", "double")
    shape = T.StructType([f for f in rows.schema.fields if f.name != "_raw"]).add("spans", T.ArrayType(span))
    out = rows.mapInArrow(find, shape)
    return out.select("doc_id", *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], "spans")


def listed(spans, kinds=KINDS):
    """kind:start:end of the spans of these kinds, comma-joined."""
    some = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with each run of overlapping spans replaced by ``mask``; all rows and columns stay. A NULL text stays NULL."""
    known = identifiers(docs, text)
    primer = "\n".join([*reversed(known), *IDENTIFIERS]).encode()
    place = docs.columns.index(text)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = _sizer(primer)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for i, content in enumerate(texts):
                if not content:
                    continue
                raw = content.encode()
                base = base_spans(content, raw)
                spans = sorted(base + [x[:3] for x in novel_spans(content, raw, size, base)])
                if spans:
                    out, at = [], 0
                    for start, _, end in spans:
                        if start >= at:
                            out += [content[at:start], mask]
                        at = max(at, end)
                    texts[i] = "".join(out) + content[at:]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)
