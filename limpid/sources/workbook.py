"""Workbook scans: many .xlsx files decoded by Spark tasks, one file per record.

A worksheet is limited by its format to 1,048,576 rows, so one record is bounded
however many workbooks there are. The rows of a tab leave the task in small
Arrow batches while the sheet is still being parsed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limpid.functions.dates import cell_date, iso_text
from limpid.functions.text import READER_NULLS, nullify_tokens

ROWS_SCHEMA = (
    "path string, sheet string, sheet_index int, row_no bigint, cells map<string,string>"
)
BATCH_ROWS = 4096
# Bytes of a sheet that are parsed at a time: few where a heading may be all that is wanted.
FIRST_PIECE, PIECE = 1 << 14, 1 << 19


def _decoder(
    headings_only: bool,
    sheets: Sequence[str | int] = (),
    headings: Sequence[str] = (),
    columns: Sequence[str] = (),
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task body. Nested, so it travels to executors by value.

    With ``headings`` only these columns of ``sheets`` are made, each cell with its kind.
    With ``columns`` the cells of these stand in a struct, all others in a map.
    """
    batch_rows, sheets, headings, columns = BATCH_ROWS, tuple(sheets), tuple(headings), tuple(columns)
    first_size, next_size = FIRST_PIECE, PIECE

    def decode(batches):
        import io
        import posixpath
        import re
        import zipfile
        from functools import cache
        from xml.etree.ElementTree import TreeBuilder, XMLParser, iterparse

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        typed = pa.struct([(h, pa.struct([("text", pa.string()), ("kind", pa.string())])) for h in headings])
        texts, by_name = pa.struct([(h, pa.string()) for h in columns]), pa.map_(pa.string(), pa.string())
        schema = pa.schema(
            [
                ("path", pa.string()),
                ("sheet", pa.string()),
                ("sheet_index", pa.int32()),
                ("row_no", pa.int64()),
                ("cells", typed if headings else texts if columns else by_name),
                *([("others", by_name)] if columns else []),
            ]
        )
        # Numbers of the built-in date and time formats.
        date_formats = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
        # Between the day zero of the 1904 date system and that of 1900.
        days_1904 = 1462

        def shows_date(code):
            """Whether a format code has a day, month, year or time outside quotes and brackets."""
            bare = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]|_.|\*.', "", code.split(";")[0])
            return bool(re.search("[dmyhs]", bare, re.IGNORECASE)) and "general" not in bare.lower()

        def date_styles(book):
            """For each cell style, whether it shows numbers as dates."""
            if "xl/styles.xml" not in book.namelist():
                return []
            own = {
                int(n.get("numFmtId")): shows_date(n.get("formatCode", ""))
                for n in elements(book, "xl/styles.xml", "numFmt")
            }
            return [
                own.get(number, number in date_formats)
                for styles in elements(book, "xl/styles.xml", "cellXfs")
                for number in [int(xf.get("numFmtId", 0)) for xf in styles]
            ]

        def kind_of(cell, dates):
            kind = cell.get("t", "n")
            if kind != "n":
                return {"b": "boolean", "d": "date"}.get(kind, "text")
            style = int(cell.get("s", 0))
            return "date" if style < len(dates) and dates[style] else "number"

        def plain(tag):
            return tag.rpartition("}")[2]

        def elements(book, part, name):
            """Elements of that name, emptied once used so that memory stays flat."""
            with book.open(part) as stream:
                for _, node in iterparse(stream):
                    if node.tag.endswith(name) and plain(node.tag) == name:
                        yield node
                        node.clear()

        def sheet_pieces(book, part, quick=None):
            """Lists of row elements of a sheet, read piece by piece; used ones leave the tree.

            Pieces end with a row. ``quick`` may answer for the text of whole rows; what it answers
            for is not parsed, and comes out in place of a list.
            """
            builder = TreeBuilder()
            parser, data, rest, size = XMLParser(target=builder), None, b"", first_size

            def rows():
                nonlocal data
                root = builder.close()
                if data is None and root is not None:
                    data = next((n for n in root if plain(n.tag) == "sheetData"), None)
                if data is None:
                    return []
                # The last row may still be open, unless the piece was cut behind it.
                end = len(data) if quick else -1
                ready = data[:end]
                del data[:end]
                return ready

            with book.open(part) as stream:
                while read := stream.read(size):
                    rest, size = rest + read, next_size
                    # The first piece ends with the first row, which nearly always is the heading.
                    found_row = rest.find if data is None else rest.rfind
                    end = found_row(b"</row>") + 6 if quick else len(rest)
                    if end < 6:
                        end = len(rest)
                    piece, rest = rest[:end], rest[end:]
                    inside = data is not None
                    # In a comment or the like, and under other names, rows are not what they seem.
                    if quick and (b"<!" in piece or not piece.endswith(b"</row>")):
                        quick = None
                    found = quick(piece) if quick and inside else None
                    if found is not None:
                        yield found
                        continue
                    parser.feed(piece)
                    yield rows()
                    if quick and not inside and not (data is not None and plain_head(piece, data)):
                        quick = None
            parser.feed(rest)
            root = parser.close()
            yield list(next((n for n in root if plain(n.tag) == "sheetData"), ()))

        def plain_head(piece, data):
            """Whether a sheet begins as UTF-8 and names its rows without a prefix."""
            said = re.match(rb"""[^>]*\sencoding=["']([^"']*)""", piece)
            return (
                b"<sheetData>" in piece
                and data.tag.startswith("{")
                and (not said or said[1].upper() == b"UTF-8")
                and not piece.startswith((b"\xff\xfe", b"\xfe\xff"))
            )

        # Tags of a row, from the codes of those that may follow. Nothing else makes quick rows.
        follows = {
            "<row": ["<c", "<c/", "</row>"],
            "<c": ["<v>", "<is>", "</c>"],
            "<c/": ["<c", "<c/", "</row>"],
            "<v>": ["</v>"],
            "</v>": ["</c>"],
            "<is>": ["<t>"],
            "<t>": ["</t>"],
            "</t>": ["</is>"],
            "</is>": ["</c>"],
            "</c>": ["<c", "<c/", "</row>"],
            "</row>": ["<row"],
        }
        code = {tag: i for i, tag in enumerate(follows, 1)}
        allowed = np.zeros((len(code) + 1, len(code) + 1), bool)
        for tag, others in follows.items():
            allowed[code[tag], [code[o] for o in others]] = True
        # The first bytes of a tag as a number; ``kept[n]`` keeps n of them.
        kept = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

        def number_of(tag):
            return np.uint64(int.from_bytes(tag, "little"))

        # Tags without attributes, each in a slot of its own; ``spread`` is found, not chosen.
        closed = {int(number_of(tag.encode())): code[tag] for tag in code if tag.endswith(">")}
        factors = (0x9E3779B97F4A7C15 * m % (1 << 64) | 1 for m in range(1, 1 << 20))
        spread = next(m for m in factors if len({w * m % (1 << 64) >> 56 for w in closed}) == len(closed))
        words_at, codes_at = np.zeros(256, np.uint64), np.zeros(256, np.int8)
        for word, number in closed.items():
            words_at[word * spread % (1 << 64) >> 56] = word
            codes_at[word * spread % (1 << 64) >> 56] = number
        spread = np.uint64(spread)
        spaced = np.frombuffer(b'<t xml:space="preserve">', np.uint8)
        row_rest = re.compile(rb'(?: [a-zA-Z0-9:]+="[^"<&]*")*>')
        cell_rest = re.compile(rb'(?: s="[0-9]+")?(?: t="([a-zA-Z]+)")?(/?)>')
        entities = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}
        widest = 24  # bytes behind the place of a cell in its tag

        def words_of(text):
            """The eight bytes from each place of a text as a number, without a copy."""
            return np.ndarray(len(text) - 7, "<u8", text, strides=(1,))

        def digits_behind(text, at):
            """(number, place behind it) of the at most seven digits at each place."""
            number, at, more = np.zeros(len(at), np.int64), at.copy(), True
            for _ in range(8):
                digit = text[at] - np.uint8(48)  # below zero it wraps around
                more &= digit <= 9
                if not np.any(more):
                    break
                number = np.where(more, number * 10 + digit, number)
                at += more
            return number, at

        def cut_out(text, begins, ends):
            """Arrow strings of the pieces of a text."""
            sizes = ends - begins
            offsets = np.zeros(len(sizes) + 1, np.int32)
            np.cumsum(sizes, out=offsets[1:])
            taken = text[np.repeat(begins - offsets[:-1], sizes) + np.arange(offsets[-1])]
            return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(taken))

        def tags_of(text):
            """(codes, first, last byte) of the tags of a text; ``None`` if a tag is none of a quick row."""
            begin, end = np.flatnonzero(text == 60), np.flatnonzero(text == 62)
            if len(begin) != len(end) or not ((begin < end).all() and (end[:-1] < begin[1:]).all()):
                after = np.searchsorted(end, begin)
                if not len(begin) or after[-1] == len(end):
                    return None
                end = end[after]
            size = end - begin + 1
            words = words_of(text)[begin]
            first = words & kept[np.minimum(size, 8)]
            slot = first * spread >> np.uint64(56)
            codes = np.where((words_at[slot] == first) & (size <= 8), codes_at[slot], 0)
            others = np.flatnonzero(codes == 0)
            words, begins, ends = words[others], begin[others], end[others]
            is_cell = words & kept[6] == number_of(b'<c r="')
            found = np.where(text[ends - 1] == 47, code["<c/"], code["<c"]) * is_cell
            found[words == number_of(b'<row r="')] = code["<row"]
            begins_t = np.flatnonzero((found == 0) & (ends - begins + 1 == len(spaced)))
            if len(begins_t):
                seen = np.lib.stride_tricks.sliding_window_view(text, len(spaced))[begins[begins_t]]
                found[begins_t] = (seen == spaced).all(axis=1) * code["<t>"]
            codes[others] = found
            good = codes[0] == code["<row"] and codes[-1] == code["</row>"] and allowed[codes[:-1], codes[1:]].all()
            return (codes, begin, end) if good else None

        def cell_tags(text, begin, end):
            """(columns, codes of what is behind the place, that text) of cell tags."""
            letters = [text[begin + i].astype(np.int64) - 64 for i in (6, 7, 8)]
            named = [(x >= 1) & (x <= 26) for x in letters]
            named[2] &= named[1]
            if not named[0].all():
                return None
            column = letters[0]
            for letter, there in zip(letters[1:], named[1:]):
                column = np.where(there, column * 26 + letter, column)
            start = begin + 7 + named[1] + named[2]
            _, stop = digits_behind(text, start)
            size = end - stop
            if (stop == start).any() or (text[stop] != 34).any() or (size > widest).any():
                return None
            rest = np.empty((len(stop), 3), np.uint64)
            for i in range(3):
                rest[:, i] = words_of(text)[stop + 1 + 8 * i] & kept[np.clip(size - 8 * i, 0, 8)]
            words = pa.FixedSizeBinaryArray.from_buffers(pa.binary(widest), len(rest), [None, pa.py_buffer(rest)])
            words = words.dictionary_encode()
            tails = [cell_rest.fullmatch(x.rstrip(b"\0")) for x in words.dictionary.to_pylist()]
            return None if None in tails else (column - 1, words.indices.to_numpy(), tails)

        def whole_rows(piece, shared, names):
            """(rows, row numbers, cells) of the text of whole rows, all cells at once.

            ``None`` if a row or cell has another form than most writers give it.
            """
            if b"<?" in piece or b"]]>" in piece or b"xmlns" in piece:
                return None
            amps = piece.count(b"&")
            if amps and amps != sum(piece.count(e.encode()) for e in entities):
                return None
            text = np.frombuffer(piece + bytes(widest), np.uint8)
            low = text[: len(piece)]
            low = low[low < 32]
            if ((low != 9) & (low != 10)).any():
                return None
            try:
                piece.decode()
            except UnicodeDecodeError:
                return None
            if (found := tags_of(text)) is None:
                return None
            codes, begin, end = found
            # Between tags, only cells hold more than blanks.
            gap = np.diff(begin, append=len(piece)) - end + begin - 1
            gap[(codes == code["<v>"]) | (codes == code["<t>"])] = 0
            if begin[0] or gap.any():
                between = np.flatnonzero(gap)
                blanks = cut_out(text, end[between] + 1, end[between] + 1 + gap[between]).to_pylist()
                if "".join([piece[: begin[0]].decode(), *blanks]).strip(" \t\n"):
                    return None
            is_row, is_cell = codes == code["<row"], (codes == code["<c"]) | (codes == code["<c/"])
            row_no, stop = digits_behind(text, begin[is_row] + 8)
            if (stop == begin[is_row] + 8).any() or (text[stop] != 34).any():
                return None
            rests = {piece[a:b] for a, b in zip((stop + 1).tolist(), (end[is_row] + 1).tolist())}
            if not all(map(row_rest.fullmatch, rests)):
                return None
            owner = np.cumsum(is_row)[is_cell] - 1
            at = np.flatnonzero(is_cell)
            column, which, tails = np.zeros(0, np.int64), np.zeros(0, np.int64), []
            if len(at):
                if (parsed := cell_tags(text, begin[at], end[at])) is None:
                    return None
                column, which, tails = parsed
            if (np.diff((owner << 20) + column) <= 0).any():
                return None
            inline = codes[at + 1] == code["<is>"]
            valued = inline | (codes[at + 1] == code["<v>"])
            opened = at + np.where(inline, 2, 1)
            begins = np.where(valued, end[opened] + 1, 0)
            ends = np.where(valued, begin[np.where(valued, opened + 1, 0)], 0)

            def bare(kind):
                mine = np.array([t[1] == kind for t in tails], bool)
                return (mine[which] & ~inline) if len(at) else np.zeros(0, bool)

            try:
                value = cut_out(text, begins, ends)
                if amps:
                    for name, sign in entities.items():
                        value = pc.replace_substring(value, name, sign)
                if (from_list := bare(b"s")).any():
                    from_list = pa.array(from_list)
                    places = value.filter(from_list).cast(pa.int64())
                    value = pc.replace_with_mask(value, from_list, pa.array(shared, pa.string()).take(places))
                if (truth := bare(b"b")).any():
                    value = pc.if_else(pa.array(truth), pc.if_else(pc.equal(value, "1"), "True", "False"), value)
            except (pa.ArrowInvalid, IndexError):
                return None
            filled = (inline | (ends > begins)) & ~bare(b"e")
            there = np.bincount(owner[filled], minlength=is_row.sum()) > 0
            place = (np.cumsum(there) - 1)[owner[filled]]
            cells = cells_of(place, column[filled], value.filter(pa.array(filled)), there.sum(), names)
            return is_row.sum(), pa.array(row_no[there]), cells

        def as_maps(place, column, value, n):
            """Cells as maps by column name; ``column`` holds names, places ascend."""
            ends = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=n))])
            return pa.MapArray.from_arrays(pa.array(ends, pa.int32()), column, value)

        def cells_of(place, column, value, n, names):
            """The cell columns of ``n`` rows from the row, sheet column and text of each cell."""
            used, which = np.unique(column, return_inverse=True)
            found = [names.get(c, f"Unnamed: {c}") for c in used.tolist()]
            if not columns:
                keys = pa.array(found, pa.string()).take(pa.array(which))
                return [as_maps(place, keys, value, n)]
            fields, rest = {}, np.zeros(len(place), bool)
            for i, name in enumerate(found):
                mine = which == i
                if name not in columns:
                    rest |= mine
                    continue
                spread = value.filter(pa.array(mine))
                if len(spread) < n:
                    source = np.full(n, -1)
                    source[place[mine]] = np.arange(len(spread))
                    spread = spread.take(pa.array(source, mask=source < 0))
                fields[name] = pc.coalesce(fields[name], spread) if name in fields else spread
            struct = pa.StructArray.from_arrays(
                [fields.get(h, pa.nulls(n, pa.string())) for h in columns], list(columns)
            )
            others = pa.nulls(n, schema.field("others").type)
            if rest.any():
                keys = pa.array(found, pa.string()).take(pa.array(which[rest]))
                maps = as_maps(place[rest], keys, value.filter(pa.array(rest)), n)
                some = np.bincount(place[rest], minlength=n) > 0
                others = pc.if_else(pa.array(some), maps, pa.scalar(None, maps.type))
            return [struct, others]

        def text_of(node):
            # Phonetic runs (rPh) annotate the text, they are not part of it.
            name = plain(node.tag)
            if name == "rPh":
                return ""
            own = (node.text or "") if name == "t" else ""
            return own + "".join(map(text_of, node))

        @cache
        def column_number(letters):
            number = 0
            for letter in letters:
                number = number * 26 + ord(letter) - 64
            return number - 1

        def cell_text(cell, shared):
            kind = cell.get("t")
            for child in cell:
                if child.tag.endswith("}is"):
                    return text_of(child)
                if child.tag.endswith("}v") and child.text is not None and kind != "e":
                    raw = child.text
                    if kind == "s":
                        return shared[int(raw)]
                    if kind == "b":
                        return "True" if raw == "1" else "False"
                    return raw
            return None

        def sheet_rows(book, part, shared, dates=None, shift=0, quick=None):
            """(row number, cells); a cell is its text, or (text, kind) where styles are given.

            Rows that ``quick`` answers for come as (their row numbers, their cell columns).
            """
            pieces, count = sheet_pieces(book, part, quick), 0
            for piece in pieces:
                if isinstance(piece, tuple):
                    count += piece[0]
                    yield piece[1:]
                    continue
                for row in piece:
                    count += 1
                    yield from filled_row(row, count, shared, dates, shift)

        def filled_row(row, count, shared, dates, shift):
            cells = {}
            for position, cell in enumerate(row):
                value = cell_text(cell, shared)
                if value is not None:
                    ref = cell.get("r")
                    place = column_number(ref.rstrip("0123456789")) if ref else position
                    if dates is not None:
                        kind = kind_of(cell, dates)
                        if shift and kind == "date" and cell.get("t", "n") == "n":
                            value = repr(float(value) + shift)
                        value = (value, kind)
                    cells[place] = value
            if cells:
                yield int(row.get("r", count)), cells

        def headings_of(cells):
            used, names = {}, {}
            for place in range(max(cells) + 1):
                base = cells.get(place) or f"Unnamed: {place}"
                seen = used.get(base, 0)
                used[base] = seen + 1
                names[place] = f"{base}.{seen}" if seen else base
            return names

        def workbook_rows(path, content):
            book = zipfile.ZipFile(io.BytesIO(content))
            links = {
                n.get("Id"): n.get("Target")
                for n in elements(book, "xl/_rels/workbook.xml.rels", "Relationship")
            }
            shared = []
            if "xl/sharedStrings.xml" in book.namelist():
                shared = [text_of(n) for n in elements(book, "xl/sharedStrings.xml", "si")]
            tabs = [
                (n.get("name"), next(v for k, v in n.attrib.items() if plain(k) == "id"))
                for n in elements(book, "xl/workbook.xml", "sheet")
            ]
            dates = date_styles(book) if headings else None
            base_1904 = any(
                n.get("date1904") in ("1", "true") for n in elements(book, "xl/workbook.xml", "workbookPr")
            )
            for index, (name, link) in enumerate(tabs):
                if headings and name not in sheets and index not in sheets:
                    continue
                part = posixpath.normpath(posixpath.join("xl", links[link])).lstrip("/")
                part = part if part in book.namelist() else links[link].lstrip("/")
                names = None

                # Kinds of cells and single headings are read element by element.
                def quick(text):
                    return whole_rows(text, shared, names) if names else None

                shift, answers = days_1904 * base_1904, None if headings or headings_only else quick
                for row_no, cells in sheet_rows(book, part, shared, dates, shift, answers):
                    if isinstance(cells, list):
                        place = zip((path, name, index), schema)
                        same = [pa.repeat(pa.scalar(x, f.type), len(row_no)) for x, f in place]
                        yield pa.RecordBatch.from_arrays([*same, row_no, *cells], schema=schema)
                        continue
                    if names is None:
                        names = headings_of({p: v[0] for p, v in cells.items()} if headings else cells)
                        if headings_only:
                            yield path, name, index, row_no, [(n, n) for n in names.values()]
                            break
                        continue
                    if headings:
                        filled = {names.get(p): {"text": v, "kind": k} for p, (v, k) in cells.items()}
                        yield path, name, index, row_no, {h: filled.get(h) for h in headings}
                        continue
                    named = [(names.get(p, f"Unnamed: {p}"), v) for p, v in cells.items()]
                    if columns:
                        rest = [(h, v) for h, v in named if h not in columns]
                        yield path, name, index, row_no, dict(reversed(named)), rest or None
                        continue
                    yield path, name, index, row_no, named

        def as_batch(rows):
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema
            )

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                pending = []
                for row in workbook_rows(path.as_py(), content.as_py()):
                    if isinstance(row, pa.RecordBatch):
                        if pending:
                            yield as_batch(pending)
                            pending = []
                        yield row
                        continue
                    pending.append(row)
                    if len(pending) == batch_rows:
                        yield as_batch(pending)
                        pending = []
                if pending:
                    yield as_batch(pending)

    return decode


def decode_workbooks(
    files: DataFrame, headings_only: bool = False, columns: Sequence[str] = ()
) -> DataFrame:
    """Rows of all tabs of the workbooks in ``files(path, content)``.

    The first filled row of a tab is its heading; every later filled row becomes
    a map from heading to cell text. Dates stay spreadsheet serial numbers.

    With ``columns`` (see ``plain_headings``) ``cells`` is a struct of these headings, so a written
    table of it is read column by column; cells under any other heading stand in the map ``others``.
    """
    decoder = _decoder(headings_only, columns=() if headings_only else columns)
    if headings_only or not columns:
        return files.select("path", "content").mapInArrow(decoder, ROWS_SCHEMA)
    plain = T.StructType.fromDDL("path string, sheet string, sheet_index int, row_no bigint")
    schema = plain.add("cells", T.StructType([T.StructField(h, T.StringType()) for h in columns]))
    others = T.MapType(T.StringType(), T.StringType())
    return files.select("path", "content").mapInArrow(decoder, schema.add("others", others))


def plain_headings(headings: Iterable[str]) -> list[str]:
    """Headings that can be fields of a written struct: letters, digits and blanks only, and
    the first of several that differ in case only."""
    first: dict[str, str] = {}
    for h in headings:
        if re.fullmatch(r"[\w ]+", h):
            first.setdefault(h.lower(), h)
    return list(first.values())


def decode_tabs(files: DataFrame, sheets: Sequence[str | int], headings: Sequence[str]) -> DataFrame:
    """Rows of some tabs with some columns, each cell as (text, kind).

    Only the parts of these tabs are parsed, and no other column leaves the task. The kind is
    ``number``, ``text``, ``boolean``, or ``date`` for a number whose format shows a date;
    serial numbers are in the 1900 date system whatever the workbook's own. ``cells`` is a
    struct by heading, so a written table of it is read column by column.
    """
    one = T.StructType([T.StructField("text", T.StringType()), T.StructField("kind", T.StringType())])
    cells = T.StructType([T.StructField(h, one) for h in headings])
    if not headings:
        raise ValueError("no headings asked for")
    plain = T.StructType.fromDDL("path string, sheet string, sheet_index int, row_no bigint")
    schema = plain.add("cells", cells)
    return files.select("path", "content").mapInArrow(_decoder(False, sheets, headings), schema)


def typed_tab(
    rows: DataFrame,
    sheet: str | int,
    headings: Sequence[str],
    dates: Sequence[str] = (),
    with_order: bool = True,
    null_tokens: Sequence[str] = READER_NULLS,
) -> DataFrame:
    """One tab of ``decode_tabs`` as text columns, and ``dates`` as dates.

    A cell that the workbook shows as a date is ISO text in a text column. In a date column
    a number is a serial number and text is a year, ISO or day first; see ``cell_date``. For
    each date column ``<name>_illisible`` holds the text that is no date.
    """
    out = []
    for h in headings:
        cell = F.col("cells")[h]
        text = nullify_tokens(cell["text"], null_tokens) if null_tokens else cell["text"]
        if h in dates:
            found = cell_date(text, cell["kind"])
            out += [found.alias(h), F.when(found.isNull(), text).alias(f"{h}_illisible")]
        else:
            shown = F.when(cell["kind"] == "date", iso_text(cell_date(text, cell["kind"])))
            out.append(F.coalesce(shown, text).alias(h))
    order = [
        F.col("path").alias("_src_file"),
        F.col("sheet_index").cast("bigint").alias("_src_block"),
        F.col("row_no").alias("_src_row"),
    ]
    return _on_tab(rows, sheet).select(*out, *(order if with_order else []))


def read_workbook_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, content) of the workbooks; files are packed into tasks by size."""
    return (
        spark.read.format("binaryFile")
        .load(paths if isinstance(paths, str) else list(paths))
        .select("path", "content")
    )


def _is_tab(sheet: str | int) -> Column:
    return (F.col("sheet_index") if isinstance(sheet, int) else F.col("sheet")) == F.lit(sheet)


def _on_tab(rows: DataFrame, sheet: str | int) -> DataFrame:
    return rows.where(_is_tab(sheet))


def tab_headings(headings: DataFrame, sheet: str | int) -> list[str]:
    """Distinct headings of one tab, in sheet order.

    Bounded by the width of a worksheet: what reaches the driver is names, never
    rows. ``headings`` comes from a ``headings_only`` decode.
    """
    return headings_of_tabs(headings, [sheet])[0]


def headings_of_tabs(headings: DataFrame, sheets: Sequence[str | int]) -> list[list[str]]:
    """``tab_headings`` of several tabs, in one job."""
    asked = F.array(*[F.when(_is_tab(sheet), i) for i, sheet in enumerate(sheets)])
    tabs = headings.withColumn("tab", F.explode(F.array_compact(asked)))
    names = tabs.select("tab", F.posexplode(F.map_keys("cells")).alias("place", "name"))
    first = names.groupBy("tab", "name").agg(F.min("place").alias("place"))
    found: list[list[str]] = [[] for _ in sheets]
    for r in first.orderBy("tab", "place", "name").collect():
        found[r["tab"]].append(r["name"])
    return found


def workbook_tab(
    rows: DataFrame,
    sheet: str | int,
    headings: Sequence[str],
    with_order: bool = True,
    null_tokens: Sequence[str] = READER_NULLS,
) -> DataFrame:
    """One tab, by name or position, as a table of text columns.

    A heading absent from some workbook gives NULL there.
    """
    order = [
        F.col("path").alias("_src_file"),
        F.col("sheet_index").cast("bigint").alias("_src_block"),
        F.col("row_no").alias("_src_row"),
    ]
    kind = rows.schema["cells"].dataType
    fields = set(kind.names) if isinstance(kind, T.StructType) else None

    def cell(h: str) -> Column:
        text = F.col("cells")[h] if fields is None or h in fields else F.col("others")[h]
        return (nullify_tokens(text, null_tokens) if null_tokens else text).alias(h)

    cells = [cell(h) for h in headings]
    return _on_tab(rows, sheet).select(*cells, *(order if with_order else []))


def read_workbook_tab(
    spark: SparkSession,
    paths: str | Sequence[str],
    sheet: str | int,
    headings: Sequence[str] | None = None,
    with_order: bool = True,
) -> DataFrame:
    """Scan one tab of many workbooks.

    To read several tabs, decode once with ``decode_workbooks``, write that table,
    and take the tabs from it with ``workbook_tab``.
    """
    files = read_workbook_files(spark, paths)
    if headings is None:
        headings = tab_headings(decode_workbooks(files, headings_only=True), sheet)
    return workbook_tab(decode_workbooks(files), sheet, headings, with_order)
