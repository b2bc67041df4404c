"""Reading and writing: delimited text, workbooks, Parquet tables, quarantine."""

from limpid.sources.delimited import UNREADABLE, read_delimited, split_unreadable
from limpid.sources.footers import file_footers
from limpid.sources.roworder import ROW_ORDER, drop_row_order, with_row_order
from limpid.sources.scratch import remove_folder, scratch_folder, scratch_removed
from limpid.sources.tables import (
    read_table,
    read_table_if_any,
    table_exists,
    through_table,
    write_quarantine,
    write_table,
)
from limpid.sources.workbook import (
    decode_tabs,
    decode_workbooks,
    headings_of_tabs,
    plain_headings,
    read_workbook_files,
    read_workbook_tab,
    tab_headings,
    typed_tab,
    workbook_tab,
)

__all__ = [
    "ROW_ORDER",
    "UNREADABLE",
    "decode_tabs",
    "decode_workbooks",
    "drop_row_order",
    "file_footers",
    "headings_of_tabs",
    "plain_headings",
    "read_delimited",
    "read_table",
    "read_table_if_any",
    "read_workbook_files",
    "read_workbook_tab",
    "remove_folder",
    "scratch_folder",
    "scratch_removed",
    "split_unreadable",
    "tab_headings",
    "table_exists",
    "through_table",
    "typed_tab",
    "with_row_order",
    "workbook_tab",
    "write_quarantine",
    "write_table",
]
