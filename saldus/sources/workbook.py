"""Binary workbooks (.xls, BIFF8 in a compound file) as a Spark data source: a partition for each sheet of each file, decoded by its task.

    spark.dataSource.register(WorkbookSource)
    spark.read.format("workbook").load("file:///exports/*.xls")

To plan the partitions only the names of the sheets are read, a few sectors of each file. A row has its number from the first row of the sheet's range on, its cells as text
(numbers in their shortest form), as the workbook shows them, and which of them are text there.

Defined cases: a cell that isn't there is '' in both forms; blank rows inside the range are rows; a sheet without cells has none; an encrypted workbook, one of an older format and what is no
workbook at all can't be read. A file that can't be read fails the task that reads it, with an ImportFailure of code erro_leitura.
"""

from __future__ import annotations

import fnmatch
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from typing import BinaryIO

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from saldus.sources.failures import ImportFailure

SCHEMA = "file string, sheet string, sheet_idx int, row_idx bigint, cells array<string>, shown array<string>, is_text array<boolean>"

#: Numbers of records.
BOF, EOF, BOUNDSHEET, SST, CONTINUE, FORMAT, XF, DATEMODE, FILEPASS = 0x0809, 0x000A, 0x0085, 0x00FC, 0x003C, 0x041E, 0x00E0, 0x0022, 0x002F
DIMENSIONS, LABELSST, LABEL, NUMBER, RK, MULRK, FORMULA, STRING, BOOLERR = 0x0200, 0x00FD, 0x0204, 0x0203, 0x027E, 0x00BD, 0x0006, 0x0207, 0x0205
#: Number formats that a workbook doesn't spell out.
FORMATS = {0: "General", 1: "0", 2: "0.00", 3: "#,##0", 4: "#,##0.00", 9: "0%", 10: "0.00%", 11: "0.00E+00", 14: "m/d/yy", 15: "d-mmm-yy", 16: "d-mmm", 17: "mmm-yy", 18: "h:mm AM/PM", 19: "h:mm:ss AM/PM", 20: "h:mm", 21: "h:mm:ss", 22: "m/d/yy h:mm", 37: "#,##0 ;(#,##0)", 38: "#,##0 ;(#,##0)", 39: "#,##0.00;(#,##0.00)", 40: "#,##0.00;(#,##0.00)", 45: "mm:ss", 46: "[h]:mm:ss", 47: "mmss.0", 48: "##0.0E+0", 49: "@"}
ERRORS = {0x00: "#NULL!", 0x07: "#DIV/0!", 0x0F: "#VALUE!", 0x17: "#REF!", 0x1D: "#NAME?", 0x24: "#NUM!", 0x2A: "#N/A"}
MAGIC, END = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", 0xFFFFFFFE


class Unreadable(ValueError):
    """Not a workbook of this format."""


class Compound:
    """A compound file's stream named Workbook, read by sectors as they are asked for."""

    def __init__(self, source: BinaryIO):
        self._source = source
        head = self._at(0, 512)
        if head[:8] != MAGIC:
            raise Unreadable("no compound file")
        shift, mini_shift = struct.unpack_from("<HH", head, 30)
        self._size, self._mini_size = 1 << shift, 1 << mini_shift
        n_fat, first_dir = struct.unpack_from("<LL", head, 44)
        cutoff, first_mini, _, more, n_more = struct.unpack_from("<LLLLL", head, 56)
        tables = list(struct.unpack_from("<109L", head, 76))
        while n_more and more < END and len(tables) < n_fat + 109:
            own = self._numbers(more)
            tables, more = tables + own[:-1], own[-1]
        self._fat = [x for t in tables[:n_fat] if t < END for x in self._numbers(t)]
        entry, root, own = None, END, self._chain_bytes(first_dir)
        for k, lo in enumerate(range(0, len(own), 128)):
            name = own[lo : lo + max(0, struct.unpack_from("<H", own, lo + 64)[0] - 2)].decode("utf-16-le", "replace")
            start, length = struct.unpack_from("<LL", own, lo + 116)
            if k == 0:
                root = start
            if name in ("Workbook", "Book") and entry is None:
                entry = start, length
        if entry is None:
            raise Unreadable("no workbook in the file")
        start, self.length = entry
        if self.length < cutoff:
            mini_fat = [x for s in self._chain(first_mini, self._fat) for x in self._numbers(s)]
            inside = self._chain(root, self._fat)
            per = self._size // self._mini_size
            self._sectors = [512 + (inside[s // per] * self._size) + (s % per) * self._mini_size for s in self._chain(start, mini_fat)]
            self._each = self._mini_size
        else:
            self._sectors, self._each = [(s + 1) * self._size for s in self._chain(start, self._fat)], self._size

    def _at(self, place: int, n: int) -> bytes:
        self._source.seek(place)
        return self._source.read(n)

    def _numbers(self, sector: int) -> list[int]:
        data = self._at((sector + 1) * self._size, self._size)
        if len(data) < self._size:
            raise Unreadable("the file is cut")
        return list(struct.unpack(f"<{self._size // 4}L", data))

    def _chain(self, sector: int, table: list[int]) -> list[int]:
        out = []
        while sector < END:
            if sector >= len(table) or len(out) > len(table):
                raise Unreadable("a chain of sectors that doesn't end")
            out.append(sector)
            sector = table[sector]
        return out

    def _chain_bytes(self, sector: int) -> bytes:
        return b"".join(self._at((s + 1) * self._size, self._size) for s in self._chain(sector, self._fat))

    def read(self, place: int, n: int) -> bytes:
        """n bytes of the stream from a place on; fewer at its end."""
        n = max(0, min(n, self.length - place))
        parts = []
        while n:
            k, inside = divmod(place, self._each)
            if k >= len(self._sectors):
                raise Unreadable("the file is cut")
            # Sectors that follow each other in the file are read at once.
            run = 1
            while run * self._each - inside < n and k + run < len(self._sectors) and self._sectors[k + run] == self._sectors[k] + run * self._each:
                run += 1
            part = self._at(self._sectors[k] + inside, min(n, run * self._each - inside))
            if not part:
                raise Unreadable("the file is cut")
            parts.append(part)
            place, n = place + len(part), n - len(part)
        return b"".join(parts)


def records(stream: Compound, place: int = 0) -> Iterator[tuple[int, bytes]]:
    """(number, content) of each record from a place on, to the end of its part of the stream."""
    held, start = b"", place
    while True:
        if len(held) - (place - start) < 4 + 8228:  # the longest record
            held, start = held[place - start :] + stream.read(start + len(held), 1 << 16), place
        at = place - start
        if at + 4 > len(held):
            raise Unreadable("the workbook ends in the middle")
        kind, n = struct.unpack_from("<HH", held, at)
        if at + 4 + n > len(held):
            raise Unreadable("the workbook ends in the middle")
        yield kind, held[at + 4 : at + 4 + n]
        if kind == EOF:
            return
        place += 4 + n


def text_of(data: bytes, at: int, size: int = 2) -> str:
    """A string in one record: its length in `size` bytes, how wide its characters are, the characters."""
    n = int.from_bytes(data[at : at + size], "little")
    wide = data[at + size] & 1
    return data[at + size + 1 : at + size + 1 + n * (1 + wide)].decode("utf-16-le" if wide else "latin-1", "replace")


def shared_strings(parts: list[bytes]) -> list[str]:
    """The strings of an SST record and those that continue it; the characters of a string that goes on in the next record may be of another width there."""
    k, at = 0, 8

    def take(n: int) -> bytes:
        nonlocal k, at
        out = b""
        while len(out) < n:
            if at >= len(parts[k]):
                k, at = k + 1, 0
            piece = parts[k][at : at + n - len(out)]
            out, at = out + piece, at + len(piece)
        return out

    out = []
    for _ in range(struct.unpack_from("<L", parts[0], 4)[0]):
        left, flags = struct.unpack("<HB", take(3))
        runs = struct.unpack("<H", take(2))[0] if flags & 8 else 0
        more = struct.unpack("<L", take(4))[0] if flags & 4 else 0
        said, wide = [], flags & 1
        while left:
            if at >= len(parts[k]):
                k, at = k + 1, 1
                wide = parts[k][0] & 1
            n = min(left, (len(parts[k]) - at) // (1 + wide))
            said.append(parts[k][at : at + n * (1 + wide)].decode("utf-16-le" if wide else "latin-1", "replace"))
            at, left = at + n * (1 + wide), left - n
        take(4 * runs + more)
        out.append("".join(said))
    return out


@dataclass
class Globals:
    """What all sheets of a workbook share."""

    sheets: list[tuple[str, int]] = field(default_factory=list)
    strings: list[str] = field(default_factory=list)
    formats: list[str] = field(default_factory=list)  # of each XF
    since: datetime = datetime(1899, 12, 30)


def workbook_globals(stream: Compound, names_only: bool = False) -> Globals:
    out, spelt, xfs, shared, last = Globals(), dict(FORMATS), [], [], 0
    for i, (kind, data) in enumerate(records(stream)):
        if i == 0 and (kind != BOF or struct.unpack_from("<HH", data) != (0x0600, 0x0005)):
            raise Unreadable("not a workbook of BIFF8")
        if kind == FILEPASS:
            raise Unreadable("the workbook is encrypted")
        if kind == BOUNDSHEET and data[5] == 0:
            out.sheets.append((text_of(data, 6, 1), struct.unpack_from("<L", data)[0]))
        elif out.sheets and names_only and kind not in (BOUNDSHEET, CONTINUE):
            break  # sheets are named in a row
        elif kind == FORMAT:
            spelt[struct.unpack_from("<H", data)[0]] = text_of(data, 2)
        elif kind == XF:
            xfs.append(struct.unpack_from("<H", data, 2)[0])
        elif kind == DATEMODE and data[0]:
            out.since = datetime(1904, 1, 1)
        elif kind == SST or (kind == CONTINUE and last == SST):
            shared.append(data)
            last = SST
            continue
        last = kind
    out.formats = [spelt.get(x, "General") for x in xfs]
    out.strings = shared_strings(shared) if shared else []
    return out


def short_number(x: float) -> str:
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(x)


def shown_number(x: float, code: str, since: datetime) -> str:
    """A number under a format: sections by sign, literals, thousands, decimals, percents, exponents, dates and times. What is in square brackets (colours, conditions) is left out."""
    parts = code.split(";")
    part = parts[1] if x < 0 and len(parts) > 1 else parts[2] if x == 0 and len(parts) > 2 else parts[0]
    if x < 0 and len(parts) > 1:
        x = -x
    if "general" in part.lower() or part in ("", "@"):
        plain = f"{x:.11g}" if not (x == int(x) and abs(x) < 1e11) else str(int(x))
        return plain.replace("e+", "E+").replace("e-", "E-")
    pieces: list[tuple[str, bool]] = []  # (sign or literal, whether it is a literal)
    i = 0
    while i < len(part):
        c = part[i]
        if c == '"':
            end = part.find('"', i + 1)
            end = len(part) if end < 0 else end
            pieces.append((part[i + 1 : end], True))
            i = end + 1
        elif c == "\\":
            pieces.append((part[i + 1 : i + 2], True))
            i += 2
        elif c == "_":
            pieces.append((" ", True))
            i += 2
        elif c == "*":
            i += 2
        elif c == "[":
            i = max(part.find("]", i), i) + 1
        else:
            pieces.append((c, False))
            i += 1
    signs = "".join(c.lower() for c, said in pieces if not said)
    if any(c in signs for c in "dyhs") or ("m" in signs and not any(c in signs for c in "0#?")):
        return _shown_date(x, pieces, since)
    places = [k for k, (c, said) in enumerate(pieces) if not said and c in "0#?.,%"]
    if not places:
        return "".join(c for c, _ in pieces)
    x *= 100 ** signs.count("%")
    whole, _, decimals = signs.partition(".")
    n = sum(c in "0#?" for c in decimals.partition("e")[0])
    if "e" in signs:
        body = f"{x:.{n}E}"
    else:
        body = f"{abs(x):,.{n}f}" if "," in whole else f"{abs(x):.{n}f}"
        least = whole.count("0")
        head, point, tail = body.partition(".")
        if least == 0 and head == "0" and point:
            head = ""
        head = head.rjust(least, "0") if "," not in whole else head
        while tail and decimals[len(tail) - 1 : len(tail)] == "#" and tail[-1] == "0":
            tail = tail[:-1]
        body = ("-" if x < 0 and float(body.replace(",", "") or 0) else "") + head + (point + tail if tail else "")
    first, last = places[0], max(k for k in places if pieces[k][0] != "%") if any(pieces[k][0] != "%" for k in places) else places[0]
    before = "".join(c for c, said in pieces[:first])
    after = "".join(c for c, said in pieces[last + 1 :] if said or c not in "0#?.,eE+-")
    return before + body + after


def _shown_date(x: float, pieces: list[tuple[str, bool]], since: datetime) -> str:
    when = since + timedelta(days=x) + timedelta(microseconds=500)
    half = "am/pm" in "".join(c.lower() for c, said in pieces if not said)
    runs: list[tuple[str, bool]] = []
    k = 0
    while k < len(pieces):
        c, said = pieces[k]
        low = "".join(p[0].lower() for p in pieces[k : k + 5] if not p[1])
        if low == "am/pm":
            runs.append(("am/pm", False))
            k += 5
        elif not said and c.lower() in "ymdhs":
            end = k
            while end < len(pieces) and not pieces[end][1] and pieces[end][0].lower() == c.lower():
                end += 1
            runs.append((c.lower() * (end - k), False))
            k = end
        else:
            runs.append((c, True))
            k += 1
    out = []
    for k, (run, said) in enumerate(runs):
        before = next((r for r, s in reversed(runs[:k]) if not s), "")
        after = next((r for r, s in runs[k + 1 :] if not s), "")
        if said:
            out.append(run)
        elif run == "am/pm":
            out.append("AM" if when.hour < 12 else "PM")
        elif run[0] == "y":
            out.append(f"{when.year:04d}" if len(run) > 2 else f"{when.year % 100:02d}")
        elif run[0] == "m" and (before[:1] == "h" or after[:1] == "s"):
            out.append(f"{when.minute:0{min(len(run), 2)}d}")
        elif run[0] == "m":
            out.append(when.strftime("%B" if len(run) > 3 else "%b") if len(run) > 2 else f"{when.month:0{len(run)}d}")
        elif run[0] == "d":
            out.append(when.strftime("%A" if len(run) > 3 else "%a") if len(run) > 2 else f"{when.day:0{len(run)}d}")
        elif run[0] == "h":
            out.append(f"{(when.hour % 12 or 12) if half else when.hour:0{min(len(run), 2)}d}")
        else:
            out.append(f"{when.second:0{min(len(run), 2)}d}")
    return "".join(out)


def rk(n: int) -> float:
    """A number in 30 bits: a whole number or the top of a double, of a hundredth where the lowest bit says so."""
    value = float((n - (1 << 32) if n & 0x80000000 else n) >> 2) if n & 2 else struct.unpack("<d", b"\0\0\0\0" + struct.pack("<L", n & 0xFFFFFFFC))[0]
    return value / 100 if n & 1 else value


Cell = tuple[str, str, bool]


def sheet_rows(stream: Compound, shared: Globals, place: int) -> Iterator[tuple[int, list[Cell]]]:
    """(number from the range's first row on, its cells from the range's first column on) of each row of the sheet that begins at a place; a cell: its text, as shown, whether it is text."""
    cells: dict[int, dict[int, Cell]] = {}
    span: tuple[int, int, int, int] | None = None  # first row, row after the last, first column, column after the last
    waits: tuple[int, int] | None = None  # a formula whose text comes in the next record

    def number(row: int, col: int, xf: int, x: float) -> None:
        code = shared.formats[xf] if xf < len(shared.formats) else "General"
        cells.setdefault(row, {})[col] = (short_number(x), shown_number(x, code, shared.since), False)

    def said(row: int, col: int, value: str, is_text: bool = True) -> None:
        cells.setdefault(row, {})[col] = (value, value, is_text)

    for kind, data in records(stream, place):
        if kind == DIMENSIONS:
            span = struct.unpack_from("<LLHH", data)
        elif kind == LABELSST:
            row, col, _, k = struct.unpack_from("<HHHL", data)
            said(row, col, shared.strings[k] if k < len(shared.strings) else "")
        elif kind == LABEL:
            said(*struct.unpack_from("<HH", data), text_of(data, 6))
        elif kind == NUMBER:
            number(*struct.unpack_from("<HHHd", data))
        elif kind == RK:
            row, col, xf, n = struct.unpack_from("<HHHL", data)
            number(row, col, xf, rk(n))
        elif kind == MULRK:
            row, col = struct.unpack_from("<HH", data)
            for k in range((len(data) - 6) // 6):
                xf, n = struct.unpack_from("<HL", data, 4 + 6 * k)
                number(row, col + k, xf, rk(n))
        elif kind == BOOLERR:
            row, col, _, value, is_error = struct.unpack_from("<HHHBB", data)
            said(row, col, ERRORS.get(value, "#ERR!") if is_error else ("TRUE" if value else "FALSE"), False)
        elif kind == FORMULA:
            row, col, xf = struct.unpack_from("<HHH", data)
            if data[12:14] != b"\xff\xff":
                number(row, col, xf, struct.unpack_from("<d", data, 6)[0])
            elif data[6] == 0:
                waits = row, col
            elif data[6] == 1:
                said(row, col, "TRUE" if data[8] else "FALSE", False)
            elif data[6] == 2:
                said(row, col, ERRORS.get(data[8], "#ERR!"), False)
        elif kind == STRING and waits:
            said(*waits, text_of(data, 0))
            waits = None
    if not cells:
        return
    columns = [c for row in cells.values() for c in row]
    low, high, left, right = min(cells), max(cells) + 1, min(columns), max(columns) + 1
    if span and span[1] > span[0] and span[3] > span[2]:
        low, high, left, right = min(low, span[0]), max(high, span[1]), min(left, span[2]), max(right, span[3])
    none: Cell = ("", "", False)
    for row in range(low, high):
        own = cells.get(row, {})
        yield row - low, [own.get(col, none) for col in range(left, right)]


@dataclass
class SheetOfFile(InputPartition):
    path: str
    sheet: str | None = None
    index: int = 0
    place: int = 0


class WorkbookSource(DataSource):
    """Options: path, of a file, a folder or names with * and ?; first: only the first sheet of each file."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], str(self.options.get("first", "false")).lower() == "true")


class _Reader(DataSourceReader):
    def __init__(self, path: str, first: bool):
        self.path, self.first = path, first

    def _files(self) -> list[str]:
        from pyarrow import fs

        files, at = fs.FileSystem.from_uri(self.path)
        prefix = self.path[: len(self.path) - len(at)] if self.path.endswith(at) else ""
        info = files.get_file_info(at)
        if info.type == fs.FileType.File:
            return [self.path]
        folder, pattern = (at.rstrip("/"), "*") if info.type == fs.FileType.Directory else at.rsplit("/", 1)
        found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return sorted(prefix + x.path for x in found if x.type == fs.FileType.File and fnmatch.fnmatchcase(x.base_name, pattern))

    def partitions(self) -> list[SheetOfFile]:
        out: list[SheetOfFile] = []
        for path in self._files():
            try:
                with _opened(path) as source:
                    sheets = workbook_globals(Compound(source), names_only=True).sheets
            except (Unreadable, struct.error, IndexError):
                out.append(SheetOfFile(path))  # its task says what is wrong
                continue
            out += [SheetOfFile(path, name, k, place) for k, (name, place) in enumerate(sheets[: 1 if self.first else None])]
        return out or [SheetOfFile("")]

    def read(self, partition: SheetOfFile) -> Iterator[tuple]:
        if not partition.path:
            return
        try:
            with _opened(partition.path) as source:
                stream = Compound(source)
                shared = workbook_globals(stream)
                if partition.sheet is None:
                    raise Unreadable("no sheets")
                for row, cells in sheet_rows(stream, shared, partition.place):
                    yield partition.path, partition.sheet, partition.index, row, [c[0] for c in cells], [c[1] for c in cells], [c[2] for c in cells]
        except (Unreadable, struct.error, IndexError) as e:
            raise ImportFailure("erro_leitura", f"{partition.path}: {e}") from e


def _opened(path: str) -> BinaryIO:
    from pyarrow import fs

    files, at = fs.FileSystem.from_uri(path)
    return files.open_input_file(at)
