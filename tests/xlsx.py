"""Writes small workbooks with the standard library, for the reader's tests."""

import zipfile
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


class Date(float):
    """A serial number shown as a date."""


def column(n):
    name = ""
    n += 1
    while n:
        n, rest = divmod(n - 1, 26)
        name = chr(65 + rest) + name
    return name


def _cell(ref, value, strings):
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, Date):
        return f'<c r="{ref}" s="1"><v>{float(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    if value.startswith("inline:"):
        return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value[7:])}</t></is></c>'
    if value not in strings:
        strings.append(value)
    return f'<c r="{ref}" t="s"><v>{strings.index(value)}</v></c>'


def write(path, sheets, merges=None):
    """``sheets``: {name: rows}; row 0 is spreadsheet row 1; None leaves a cell out."""
    merges, strings, parts = merges or {}, [], {}
    for n, (name, rows) in enumerate(sheets.items(), 1):
        body = ""
        for r, row in enumerate(rows, 1):
            cells = "".join(
                _cell(f"{column(c)}{r}", v, strings) for c, v in enumerate(row) if v is not None
            )
            if cells or any(True for _ in row):
                body += f'<row r="{r}">{cells}</row>' if cells else ""
        ranges = "".join(f'<mergeCell ref="{m}"/>' for m in merges.get(name, []))
        tail = f"<mergeCells>{ranges}</mergeCells>" if ranges else ""
        parts[f"xl/worksheets/sheet{n}.xml"] = (
            f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData>{tail}</worksheet>'
        )
    listed = "".join(
        f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>'
        for n, name in enumerate(sheets, 1)
    )
    links = "".join(
        f'<Relationship Id="rId{n}" Target="worksheets/sheet{n}.xml"/>'
        for n in range(1, len(sheets) + 1)
    )
    shared = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
    parts.update({
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>{listed}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}">{links}</Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{MAIN}">{shared}</sst>',
        "xl/styles.xml": f'<styleSheet xmlns="{MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
    })
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
