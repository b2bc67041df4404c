"""Workbooks made from tables, as input for the workbook scan."""

from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Headings, and rows or a table with the columns in their order.
Tab = tuple[Sequence[str], Sequence[Sequence[object]] | pa.Table]


def _writer():
    """Nested, so the function travels to executors by value and needs no install there."""

    def workbook_bytes(tabs: Mapping[str, Tab]) -> bytes:
        """A minimal .xlsx: shared strings for headings, inline text and plain numbers."""
        import datetime
        import io
        import zipfile
        from xml.sax.saxutils import escape, quoteattr

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        packed = "http://schemas.openxmlformats.org/package/2006/relationships"
        shared: list[str] = []

        def letters(number: int) -> str:
            name = ""
            number += 1
            while number:
                number, rest = divmod(number - 1, 26)
                name = chr(65 + rest) + name
            return name

        def cell(place: str, value: object, heading: bool) -> str:
            if value is None or value != value:
                return ""
            if heading:
                shared.append(str(value))
                return f'<c r="{place}" t="s"><v>{len(shared) - 1}</v></c>'
            if isinstance(value, str):
                text = f'<t xml:space="preserve">{escape(value)}</t>'
                return f'<c r="{place}" t="inlineStr"><is>{text}</is></c>'
            if isinstance(value, datetime.date):
                days = (value - datetime.date(1899, 12, 30)).days
                return f'<c r="{place}" s="1"><v>{days}</v></c>'
            return f'<c r="{place}"><v>{value}</v></c>'

        def row(number: int, values: Sequence[object]) -> str:
            cells = "".join(cell(f"{letters(i)}{number}", v, number == 1) for i, v in enumerate(values))
            return f'<row r="{number}">{cells}</row>'

        def cells_of(letter: str, values: pa.Array, numbers: pa.Array) -> pa.Array:
            """The cells of a column at once, as ``cell`` makes them."""
            kind = values.type
            if pa.types.is_string(kind) or pa.types.is_large_string(kind):
                values = values.cast(pa.string())
                for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
                    values = pc.replace_substring(values, sign, name)
                begin, end = ' t="inlineStr"><is><t xml:space="preserve">', "</t></is></c>"
            elif pa.types.is_integer(kind):
                begin, values, end = "><v>", values.cast(pa.string()), "</v></c>"
            elif pa.types.is_date32(kind):
                days = pc.add(values.cast(pa.int32()), (datetime.date(1970, 1, 1) - datetime.date(1899, 12, 30)).days)
                begin, values, end = ' s="1"><v>', days.cast(pa.string()), "</v></c>"
            else:
                places = (f"{letter}{n}" for n in numbers.to_pylist())
                return pa.array([cell(p, v, False) for p, v in zip(places, values.to_pylist())], pa.string())
            made = pc.binary_join_element_wise(f'<c r="{letter}', numbers, f'"{begin}', values, end, "")
            return made.fill_null("")

        def rows_of(table: pa.Table) -> bytes:
            numbers = pa.array(np.arange(2, len(table) + 2)).cast(pa.string())
            columns = [c.combine_chunks() for c in table.columns]
            cells = [cells_of(letters(i), c, numbers) for i, c in enumerate(columns)]
            made = pc.binary_join_element_wise('<row r="', numbers, '">', *cells, "</row>", "")
            # The texts of an array stand one behind the other.
            _, places, text = made.buffers()
            ends = np.frombuffer(places, np.int32, len(made) + 1, made.offset * 4)
            return text[ends[0] : ends[-1]].to_pybytes() if len(made) else b""

        def all_rows(headings: Sequence[str], rows: Sequence[Sequence[object]] | pa.Table) -> bytes:
            if isinstance(rows, pa.Table):
                return row(1, headings).encode() + rows_of(rows)
            return "".join(row(n, values) for n, values in enumerate([headings, *rows], start=1)).encode()

        sheets = {
            f"worksheets/sheet{i}.xml": f'<worksheet xmlns="{main}"><sheetData>'.encode()
            + all_rows(headings, rows)
            + b"</sheetData></worksheet>"
            for i, (headings, rows) in enumerate(tabs.values(), start=1)
        }
        names = "".join(
            f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="rId{i}"/>'
            for i, name in enumerate(tabs, start=1)
        )
        links = "".join(
            f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="{part}"/>'
            for i, part in enumerate(sheets, start=1)
        )
        strings = "".join(f"<si><t>{escape(s)}</t></si>" for s in shared)
        parts = {
            "workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>',
            "_rels/workbook.xml.rels": f'<Relationships xmlns="{packed}">{links}</Relationships>',
            "styles.xml": f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/>'
            "</cellXfs></styleSheet>",
            "sharedStrings.xml": f'<sst xmlns="{main}">{strings}</sst>',
            **sheets,
        }
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
            for name, text in parts.items():
                whole = text if isinstance(text, bytes) else text.encode()
                book.writestr(f"xl/{name}", b'<?xml version="1.0" encoding="UTF-8"?>' + whole)
        return out.getvalue()

    return workbook_bytes


workbook_bytes = _writer()


def as_workbooks(
    df: DataFrame, stem: str, group: str, tab: str, columns: Mapping[str, Sequence[str]]
) -> DataFrame:
    """(path, content): one workbook per value of ``group``, one tab per value of ``tab``.

    ``columns`` names the columns of each tab. ``group`` must bound its groups,
    as a range of a unique number does.
    """
    tabs = {name: list(cols) for name, cols in columns.items()}
    make = workbook_bytes

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        for i, c in enumerate(rows.schema):
            # Numbers with gaps are written as fractions: a sheet has no other kind.
            if pa.types.is_integer(c.type) and rows.column(i).null_count:
                rows = rows.set_column(i, c.name, rows.column(i).cast(pa.float64(), safe=False))
        book = {name: (cols, rows.filter(pc.equal(rows[tab], name)).select(cols)) for name, cols in tabs.items()}
        path = f"{stem}_{key[0].as_py():012d}.xlsx"
        return pa.table({"path": [path], "content": pa.array([make(book)], pa.binary())})

    books = df.groupBy(F.col(group)).applyInArrow(pack, "path string, content binary")
    # Decoding is slow per byte, so keep the workbooks in as many parts as the session runs.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return books.repartition(parts, "path")
