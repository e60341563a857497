"""One parse of a source text: its parts with their ordered fields, as rows from which records and links are made.

XML is checked by an event parser, which says what is wrong with a text that is no XML. A sound text of plain markup is then
cut at its tags by one expression; one with comments, sections or declarations is read by the parser's events. Either way
gives document order and the text of each part as it stands, at any depth and in time linear in the text.
Line-tagged text is folded line by line. What records and links are is stated elsewhere, as rules on the rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass
from operator import itemgetter
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows of a parse: of origin's text the part n, with its tag and accession, tag and accession of the part around it, its text with its SHA-256, and its fields.
PARTS = "origin string, n int, tag string, accession string, within string, owner string, raw_text string, content_hash string, fields array<struct<name:string,value:string>>, fault string"
_ARROW = pa.schema(
    [
        ("origin", pa.string()),
        ("n", pa.int32()),
        ("tag", pa.string()),
        ("accession", pa.string()),
        ("within", pa.string()),
        ("owner", pa.string()),
        ("raw_text", pa.string()),
        ("content_hash", pa.string()),
        ("fields", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
        ("fault", pa.string()),
    ]
)
_BATCH_CHARS = 1 << 24
_TAG = re.compile(rb"""<[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*>""")
_E = expat.errors
#: What is wrong with a text, by the parser's code.
_FAULTS = {
    **dict.fromkeys((_E.XML_ERROR_NO_ELEMENTS, _E.XML_ERROR_UNCLOSED_TOKEN, _E.XML_ERROR_PARTIAL_CHAR, _E.XML_ERROR_UNCLOSED_CDATA_SECTION), "truncated"),
    _E.XML_ERROR_TAG_MISMATCH: "mismatched",
    **dict.fromkeys((_E.XML_ERROR_INVALID_TOKEN, _E.XML_ERROR_UNDEFINED_ENTITY, _E.XML_ERROR_BAD_CHAR_REF), "unescaped"),
    _E.XML_ERROR_JUNK_AFTER_DOC_ELEMENT: "more than one",
}


@dataclass(slots=True)
class Part:
    """One element that becomes a row: where it begins and ends, and what lies in it in document order."""

    tag: str
    accession: str
    within: str
    owner: str
    base: int
    start: int
    fields: list[tuple[str, str]]
    end: int = 0
    text: str | None = None
    data: list[str] | None = None


def fault_of(error: expat.ExpatError) -> str:
    """What is wrong: truncated, mismatched, unescaped, more than one, or malformed for the rest."""
    return _FAULTS.get(_E.messages.get(error.code, ""), "malformed")


class _Reader:
    """Event handlers of one XML text. The root is a part, and so is each element whose tag is wanted."""

    def __init__(self, body: bytes, wanted: frozenset[str], plain: frozenset[str]) -> None:
        self.body, self.wanted, self.plain = body, wanted, plain
        self.path: list[str] = []
        self.text: list[list[str] | None] = []
        self.starts: list[int] = []
        self.open: list[Part] = []
        self.parts: list[Part] = []
        self.parser = expat.ParserCreate("UTF-8")
        self.parser.buffer_text = True
        self.parser.ordered_attributes = True
        self.parser.StartElementHandler, self.parser.EndElementHandler, self.parser.CharacterDataHandler = self.start, self.end, self.chars

    def _field(self, path: list[str], tail: str, value: str) -> None:
        for part in self.open:
            part.fields.append(("/".join(path[part.base :]) + tail, value))

    def _own_text(self) -> None:
        """The text before the first child, once."""
        if self.text and self.text[-1] is not None:
            own = "".join(self.text[-1])
            self.text[-1] = None
            if own.strip():
                self._field(self.path, "", own)

    def start(self, tag: str, attributes: list[str]) -> None:
        self._own_text()
        at = self.parser.CurrentByteIndex
        pairs = list(zip(attributes[::2], attributes[1::2], strict=True))
        right_within = bool(self.open) and self.open[-1].base + 1 == len(self.path)
        if not self.path or (tag in self.wanted and (right_within or tag not in self.plain)):
            owner = next((p.accession for p in reversed(self.open) if p.accession), "")
            part = Part(tag, dict(pairs).get("accession", ""), self.open[-1].tag if self.open else "", owner, len(self.path), at, [])
            part.data = [] if tag in self.plain else None
            self.open.append(part)
            self.parts.append(part)
        self.path.append(tag)
        self.text.append([])
        self.starts.append(at)
        for name, value in pairs:
            self._field(self.path, f"@{name}", value)

    def chars(self, text: str) -> None:
        if self.text and self.text[-1] is not None:
            self.text[-1].append(text)
        for part in self.open:
            if part.data is not None:
                part.data.append(text)

    def end(self, tag: str) -> None:
        self._own_text()
        at, start = self.parser.CurrentByteIndex, self.starts.pop()
        self.path.pop()
        self.text.pop()
        if self.open and self.open[-1].base == len(self.path):
            part = self.open.pop()
            opening = _TAG.match(self.body, start).end()
            part.end = opening if self.body.startswith(b"/>", opening - 2) else self.body.index(b">", at) + 1


#: An attribute of a tag; a reference.
_ATTRIBUTE = re.compile(r"""([^ \t\n=]+)[ \t\n]*=[ \t\n]*(?:"([^"]*)"|'([^']*)')""")
_REFERENCE = re.compile(r"&(?:#x([0-9A-Fa-f]+)|#([0-9]+)|([a-z]+));")
_ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def _resolved(value: str) -> str:
    return _REFERENCE.sub(lambda m: chr(int(m[1], 16)) if m[1] else chr(int(m[2])) if m[2] else _ENTITIES[m[3]], value) if "&" in value else value


def _attributes(text: str) -> list[tuple[str, str]]:
    if "\n" in text or "\t" in text:
        text = text.replace("\n", " ").replace("\t", " ")
    return [(name, _resolved(a or b)) for name, a, b in _ATTRIBUTE.findall(text)]


def _is_plain(text: str) -> bool:
    """Whether a sound text has tags, text and references only, beside the line that declares it XML, and no > of its own."""
    return "<!" not in text and "\r" not in text and text.find("<?", 1) < 0 and text.count("<") == text.count(">")


def _plain_parts(text: str, wanted: frozenset[str], plain: frozenset[str], silent: frozenset[str]) -> list[Part]:
    """What _Reader finds, for a sound text of plain markup; places are those of characters. Parts of silent tags get no fields."""
    parts: list[Part] = []
    opened: list[Part] = []
    saying: list[tuple[list[tuple[str, str]], int]] = []  # fields of open parts, and where their paths begin
    paths, listening = [""], 0
    pieces = text.split("<")
    at = len(pieces[0])
    for piece in pieces[1:]:
        start, at = at, at + len(piece) + 1
        head, after = piece.split(">")
        first = head[0]
        if first == "?":
            continue
        closing = first == "/"
        empty = not closing and head[-1] == "/"
        if closing:
            paths.pop()
        else:
            if empty:
                head = head[:-1]
            pairs = ()
            tag, said = head.split(None, 1) if "=" in head else (head.rstrip(), "")
            depth = len(paths) - 1
            begins = not depth or (tag in wanted and (tag not in plain or opened[-1].base + 1 == depth))
            if said and (saying or begins):
                pairs = _attributes(said)
            if begins:
                accession = owner = ""
                for name, value in pairs:
                    if name == "accession":
                        accession = value
                for p in reversed(opened):
                    if p.accession:
                        owner = p.accession
                        break
                part = Part(tag, accession, opened[-1].tag if opened else "", owner, depth, start, [])
                if tag in plain:
                    part.data = []
                    listening += 1
                opened.append(part)
                parts.append(part)
                if tag not in silent:
                    saying.append((part.fields, len(paths[-1])))
            path = paths[-1] + tag
            if saying:
                for name, value in pairs:
                    for fields, begin in saying:
                        fields.append((f"{path[begin:]}@{name}", value))
                if after and not empty:
                    value = _resolved(after)
                    if value.strip():
                        for fields, begin in saying:
                            fields.append((path[begin:], value))
            if not empty:
                paths.append(path + "/")
        if (closing or empty) and opened and opened[-1].base == len(paths) - 1:
            part = opened.pop()
            part.end = start + len(piece) + 1 - len(after)
            if part.data is not None:
                listening -= 1
            if part.tag not in silent:
                saying.pop()
        if listening and after:
            for part in opened:
                if part.data is not None:
                    part.data.append(_resolved(after))
    return parts


@dataclass(frozen=True)
class Shape:
    """Which parts of an XML text become rows, and what of them is kept.

    wanted: tags that are parts beside the root; texts: tags that keep their text; whole: tags that take the whole
    text; plain: tags that are parts only right within another
    part, and keep their character data without markup; bare: tags without fields. The root
    takes the accession of its first part of the tag head, and a text without one is at fault; lend gives the parts
    of a tag one attribute of the first part of another, as a last field.
    """

    wanted: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()
    whole: tuple[str, ...] = ()
    plain: tuple[str, ...] = ()
    bare: tuple[str, ...] = ()
    head: str = ""
    lend: tuple[tuple[str, str, str], ...] = ()


class NoPart(ValueError):
    """A text lacks the part that gives it its accession."""


def xml_parts(text: str, shape: Shape) -> list[Part]:
    """The root and each element of a wanted tag, in document order.

    Fields are (path, value): attributes as path@name, then an element's text before its first child as served,
    then its children. Paths begin at the part. owner is the accession of the nearest part around it that has one.
    """
    body, wanted, plain = text.encode("utf-8", "surrogatepass"), frozenset(shape.wanted), frozenset(shape.plain)
    if _is_plain(text):
        expat.ParserCreate("UTF-8").Parse(body, True)
        parts, span = _plain_parts(text, wanted, plain, frozenset(shape.bare) - {giver for _, giver, _ in shape.lend}), lambda p: text[p.start : p.end]
    else:
        reader = _Reader(body, wanted, plain)
        reader.parser.Parse(body, True)
        parts, span = reader.parts, lambda p: body[p.start : p.end].decode("utf-8", "surrogatepass")
    if shape.head:
        own = next((p.accession for p in parts[1:] if p.tag == shape.head), None)
        if own is None:
            raise NoPart(f"no {shape.head}")
        parts[0].accession = own
        for part in parts[1:]:
            part.owner = part.owner or own
    for tag, giver, name in shape.lend:
        given = next((v for p in parts if p.tag == giver for n, v in p.fields if n == f"{giver}@{name}"), None)
        for part in parts:
            if part.tag == tag and given is not None:
                part.fields.append((f"{giver}@{name}", given))
    for part in parts:
        if part.data is not None:
            part.text = "".join(part.data)
        elif part.tag in shape.whole:
            part.text = text
        elif part.tag in shape.texts:
            part.text = span(part)
        if part.tag in shape.bare:
            part.fields = []
    return parts


#: Line-tagged text: lines that begin a table, that end one, and that begin an entity.
_TABLE = tuple(f"!{kind}_table_{{}}" for kind in ("sample", "platform", "series"))
_BEGINS, _ENDS = tuple(t.format("begin") for t in _TABLE), tuple(t.format("end") for t in _TABLE)


def tagged_parts(text: str) -> list[Part]:
    """The blocks of line-tagged text, one for each line ^ENTITY = KEY, as served; the tag is the entity, the accession its key.

    Fields are the lines !name = value outside tables, empty values too; a table without its end line lasts until
    the next entity. Lines before the first entity belong to none.
    """
    parts: list[Part] = []
    table, at = False, 0
    fields: list[tuple[str, str]] = []
    for line in text.splitlines(keepends=True):
        at += len(line)
        first = line[0]
        if first == "^":
            if parts:
                parts[-1].end = at - len(line)
            entity, _, key = line[1:].partition(" = ")
            fields = []
            parts.append(Part(entity.strip(), key.strip(), "", "", 0, at - len(line), fields))
            table = False
        elif first == "!" and parts:
            if "_table_" in line and line.startswith(_BEGINS):
                table = True
            elif "_table_" in line and line.startswith(_ENDS):
                table = False
            elif not table:
                bare = line[1:].rstrip("\r\n")
                name, between, value = bare.partition(" = ")
                fields.append((name, value) if between else (bare.removesuffix(" ="), ""))
    if parts:
        parts[-1].end = at
    for part in parts:
        part.text = text[part.start : part.end]
    return parts


#: Plain text in markup, from its first character that is no white space; what a value in quotes, and such a text, must not hold to be nothing but a value.
_DATA = re.compile(r">([^<\s][^<]*)<")
_ODD = "\ud800-\udfff\ufffe\uffff"
_NO_VALUE, _NO_DATA = re.compile(f"[<>&\x00-\x1f{_ODD}]"), re.compile(f'[">&\x00-\x08\x0b-\x1f{_ODD}]')
#: The value of a tagged line; what else than its end would end it for splitlines.
_VALUE, _ENDING = re.compile(" = ([^\r\n]*)"), re.compile("[\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
#: A value's place in a marked text.
_MARK = re.compile("\ue000([0-9]+)\ue001")
#: So many forms of text are learned in a task, of at most so many characters without their values.
_FORMS, _FORM_CHARS = 512, 1 << 14


def _markup_form(text: str) -> tuple[str, list[str], Callable[[list[str]], str]] | None:
    """(form, values, text of other values) of a text of plain markup: texts of one form differ in values only, so all are sound or none is. None where a value may be more than that.

    Values are those in double quotes and plain texts; empty ones, texts that begin with white space and the line that declares a text XML belong to the form.
    """
    at = text.find("?>") + 2 if text.startswith("<?") else 0
    quoted = text[at:].split('"')
    pieces = _DATA.split('"'.join(quoted[::2]))
    attributes, data = quoted[1::2], pieces[1::2]
    if len(quoted) % 2 == 0 or _NO_VALUE.search("".join(attributes)) or _NO_DATA.search("".join(data)):
        return None
    form = "\0".join([text[:at], *pieces[::2]])
    if "" in attributes:
        form += f"\0{[n for n, v in enumerate(attributes) if not v]}"

    def other(values: list[str]) -> str:
        said = "<".join(f"{a}>{b}" for a, b in zip(pieces[::2], values[len(attributes) :], strict=False)) + ("<" if data else "") + pieces[-1]
        bare = said.split('"')
        return text[:at] + "".join(f'{a}"{b if v else v}"' for a, b, v in zip(bare, values, attributes, strict=False)) + bare[-1]

    return form, attributes + data, other


def _lines_form(text: str) -> tuple[str, list[str], Callable[[list[str]], str]] | None:
    """The same of line-tagged text: a line's value is what follows the first " = "."""
    pieces = _VALUE.split(text)
    values = pieces[1::2]
    if _ENDING.search("".join(values)):
        return None
    return "\0".join(pieces[::2]), values, lambda other: "".join(f"{a} = {b}" for a, b in zip(pieces[::2], other, strict=False)) + pieces[-1]


def _picker(places: list[int]) -> Callable[[list], tuple]:
    return itemgetter(*places) if len(places) > 1 else lambda pool: tuple(pool[p] for p in places)


class _Form:
    """Parts of all texts of one form: what of them is constant, and which value stands where. ValueError where that cannot be told."""

    def __init__(self, parts: list[Part], values: int, marked: str) -> None:
        self.values, constants, joins = values, {}, {}

        def place(text: str | None) -> int | tuple:
            bits = [text] if text is None else _MARK.split(text)
            if text == marked:
                return values
            if len(bits) == 3 and not bits[0] and not bits[2]:
                return int(bits[1])
            if len(bits) == 1:
                return ("c", constants.setdefault(text, len(constants)))
            spots = [("c", constants.setdefault(b, len(constants))) if n % 2 == 0 else int(b) for n, b in enumerate(bits) if n % 2 or b]
            return ("j", joins.setdefault(tuple(spots), len(joins)))

        rows = [(place(p.accession), place(p.owner), place(p.text)) for p in parts]
        fields = [place(v) for p in parts for _, v in p.fields]
        at = lambda spot: spot if isinstance(spot, int) else values + 1 + spot[1] + (len(constants) if spot[0] == "j" else 0)
        self.constants, self.joins = list(constants), [_picker([at(x) for x in spots]) for spots in joins]
        self.tags, self.withins, self.numbers = [p.tag for p in parts], [p.within for p in parts], range(len(parts))
        self.accessions, self.owners, self.texts = (_picker([at(r[k]) for r in rows]) for k in range(3))
        self.counts, self.names, self.said = [len(p.fields) for p in parts], [n for p in parts for n, _ in p.fields], _picker([at(x) for x in fields])
        if any(_MARK.search(x) for x in (*self.tags, *self.withins, *self.names)):
            raise ValueError("a name depends on a value")

    def pool(self, values: list[str], text: str) -> list:
        pool = [*values, text, *self.constants]
        for join in self.joins:
            pool.append("".join(join(pool)))
        return pool


class _Rows:
    """Rows of PARTS, column by column."""

    def __init__(self) -> None:
        self.origins, self.numbers, self.tags, self.accessions, self.withins, self.owners, self.texts, self.counts, self.names, self.values, self.faults = ([] for _ in range(11))

    def add(self, origin: str, found: list[Part]) -> None:
        self._add(origin, range(len(found)), [p.tag for p in found], [p.accession for p in found], [p.within for p in found], [p.owner for p in found], [p.text for p in found], [len(p.fields) for p in found], None)
        for part in found:
            self.names += [n for n, _ in part.fields]
            self.values += [v for _, v in part.fields]

    def fill(self, origin: str, form: _Form, pool: list) -> None:
        self._add(origin, form.numbers, form.tags, form.accessions(pool), form.withins, form.owners(pool), form.texts(pool), form.counts, None)
        self.names += form.names
        self.values += form.said(pool)

    def fail(self, origin: str, fault: str) -> None:
        self._add(origin, (0,), (None,), (None,), (None,), (None,), (None,), (0,), fault)

    def _add(self, origin, numbers, tags, accessions, withins, owners, texts, counts, fault) -> None:
        self.origins += [origin] * len(tags)
        self.numbers += numbers
        self.tags += tags
        self.accessions += accessions
        self.withins += withins
        self.owners += owners
        self.texts += texts
        self.counts += counts
        self.faults += [fault] * len(tags)

    def arrow(self, texts: bool, hashes: bool) -> pa.RecordBatch:
        ends = [0]
        for n in self.counts:
            ends.append(ends[-1] + n)
        string = lambda column: pa.array(column, pa.string())
        none = pa.nulls(len(self.tags), pa.string())
        digests = string([None if t is None else hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in self.texts]) if hashes else none
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([string(self.names), string(self.values)], names=["name", "value"]))
        arrays = [string(self.origins), pa.array(self.numbers, pa.int32()), string(self.tags), string(self.accessions), string(self.withins), string(self.owners), string(self.texts) if texts else none, digests, lists, string(self.faults)]
        return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


class Parser:
    """Parts of many texts. A form of text is parsed once, with marks for its values; other texts of that form only have their values put in place."""

    def __init__(self, parse: Callable[[str], list[Part]], form_of: Callable[[str], tuple | None]) -> None:
        self.parse, self.form_of = parse, form_of
        self.forms: dict[str, _Form | None] = {}

    def _learned(self, text: str, form: str, values: list[str], other: Callable[[list[str]], str]) -> _Form | None:
        marked = other([f"\ue000{n}\ue001" for n in range(len(values))])
        plain = self.form_of is not _markup_form or _is_plain(marked)
        if "\ue000" in form or not plain or other(values) != text:
            return None
        try:
            return _Form(self.parse(marked), len(values), marked)
        except (expat.ExpatError, ValueError):  # told from the text itself
            return None

    def read(self, rows: _Rows, origin: str, text: str) -> None:
        """Adds the parts of a text, or its fault."""
        found = self.form_of(text)
        if found is not None and len(found[0]) <= _FORM_CHARS:
            form, values, other = found
            if form not in self.forms and len(self.forms) < _FORMS:
                self.forms[form] = self._learned(text, *found)
            known = self.forms.get(form)
            if known is not None and known.values == len(values):
                pool = known.pool(values, text)
                # the key of an entity is trimmed
                if self.form_of is _markup_form or all(a == a.strip() for a in known.accessions(pool)):
                    return rows.fill(origin, known, pool)
        try:
            rows.add(origin, self.parse(text))
        except expat.ExpatError as error:
            rows.fail(origin, f"{fault_of(error)}: {error}")
        except NoPart as error:
            rows.fail(origin, str(error))


def _parsed(df: DataFrame, parse: Callable[[str], list[Part]], form_of: Callable[[str], tuple | None], texts: bool = True, hashes: bool = True) -> DataFrame:
    """Rows of PARTS of df (accession, raw_text), their texts and the hashes of these only if wanted. A null or empty text has one row of fault "empty", one that does not parse one of its fault."""

    def run(batches):
        parser = Parser(parse, form_of)
        for batch in batches:
            held, size = _Rows(), 0
            for origin, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    parser.read(held, origin, text)
                    size += len(text)
                else:
                    held.fail(origin, "empty")
                if size > _BATCH_CHARS:
                    yield held.arrow(texts, hashes)
                    held, size = _Rows(), 0
            if held.tags:
                yield held.arrow(texts, hashes)

    return df.select(F.col("accession").cast("string").alias("origin"), F.col("raw_text").cast("string").alias("raw_text")).mapInArrow(run, PARTS)


def parsed_xml(df: DataFrame, shape: Shape, hashes: bool = True) -> DataFrame:
    """Rows of PARTS of XML texts (accession, raw_text). content_hash is null where hashes is false."""
    return _parsed(df, lambda text: xml_parts(text, shape), _markup_form, hashes=hashes)


def parsed_tagged(df: DataFrame, texts: bool = True, hashes: bool = True) -> DataFrame:
    """Rows of PARTS of line-tagged texts (accession, raw_text); tag is the entity, accession its key. raw_text is null where texts is false; its hash is there unless hashes is false."""
    return _parsed(df, tagged_parts, _lines_form, texts, hashes)


def xml_faults(df: DataFrame) -> DataFrame:
    """(accession, fault) of texts that are no XML: empty, truncated, mismatched, unescaped, more than one or malformed."""
    found = df.select("accession", "raw_text")

    def run(batches):
        for batch in batches:
            keys, faults = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parser = expat.ParserCreate("UTF-8")
                try:
                    if text:
                        parser.Parse(text.encode("utf-8", "surrogatepass"), True)
                        continue
                    faults.append("empty")
                except expat.ExpatError as error:
                    faults.append(fault_of(error))
                keys.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(faults, pa.string())], names=["accession", "fault"])

    return found.select(F.col("accession").cast("string"), F.col("raw_text").cast("string")).mapInArrow(run, "accession string, fault string")


#: Runs with the statistics of their reads.
RUNS = Shape(wanted=("RUN", "Read"), texts=("RUN",))


_READS = pa.schema([("origin", pa.string()), ("accession", pa.string()), ("raw_text", pa.string()), ("reads", pa.list_(pa.struct([("index", pa.string()), ("average", pa.string())])))])


def _runs(text: str | None) -> list[tuple[str, str, list[dict[str, str | None]]]]:
    """(accession, text, reads) of each run in a text, each accession once; none of a text that is no XML."""
    try:
        found = xml_parts(text, RUNS) if text else []
    except expat.ExpatError:
        return []
    texts: dict[str, str] = {}
    reads: dict[str, list[dict[str, str | None]]] = {}
    for part in found:
        if part.tag == "RUN" and part.accession:
            texts.setdefault(part.accession, part.text)
        elif part.tag == "Read" and part.within == "RUN":
            said = dict(reversed(part.fields))
            reads.setdefault(part.owner, []).append({"index": said.get("Read@index"), "average": said.get("Read@average")})
    return [(accession, raw, reads.get(accession, [])) for accession, raw in texts.items()]


def run_blocks(df: DataFrame) -> DataFrame:
    """(accession, raw_text, lengths, structure) of the runs in XML texts (accession, raw_text).

    raw_text is the run's element as it stands, lengths the average length of each read by its index, rounded half to even;
    a read without an index or a length counts for nothing, structure joins them such as 28+94. Each text is read once. A run that stands in several
    texts is taken from the one of the least accession; texts that are no XML have no runs.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for origin, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(origin, accession, raw, reads) for accession, raw, reads in _runs(text)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _READS, strict=True)], schema=_READS)

    texts = df.select(F.col("accession").cast("string").alias("origin"), F.col("raw_text").cast("string").alias("raw_text"))
    found = texts.mapInArrow(run, "origin string, accession string, raw_text string, reads array<struct<index:string,average:string>>")
    runs = found.groupBy("accession").agg(F.min_by("raw_text", "origin").alias("raw_text"), F.min_by("reads", "origin").alias("reads"))
    numbers = F.transform("reads", lambda r: F.struct(r["index"].try_cast("long").alias("i"), F.bround(r["average"].try_cast("double")).cast("long").alias("n")))
    lengths = F.transform(F.array_sort(F.filter(numbers, lambda r: r["i"].isNotNull() & r["n"].isNotNull())), lambda r: r["n"])
    return runs.select("accession", "raw_text", lengths.alias("lengths")).select("accession", "raw_text", "lengths", F.array_join(F.col("lengths").cast("array<string>"), "+").alias("structure"))
