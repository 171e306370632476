"""Writes small binary workbooks for tests: records of BIFF8 in a compound file."""

from __future__ import annotations

import struct


def record(kind, data=b""):
    return struct.pack("<HH", kind, len(data)) + data


def text(s, size=2):
    wide = any(ord(c) > 255 for c in s)
    units = s.encode("utf-16-le") if wide else s.encode("latin-1")
    return (len(units) // 2 if wide else len(units)).to_bytes(size, "little") + bytes([wide]) + units


def shared(strings, cut=None):
    """An SST, cut after so many bytes into a record that continues it, inside a string's characters."""
    body = struct.pack("<LL", len(strings), len(strings)) + b"".join(map(text, strings))
    if cut is None:
        return record(0xFC, body)
    return record(0xFC, body[:cut]) + record(0x3C, b"\0" + body[cut:])  # the rest is of narrow characters


def sheet(cells, strings, dimensions=None):
    """cells: {(row, col): value}; a tuple (value, xf) has a format, (kind, ...) of raw records is put in as it is."""
    out = record(0x0809, struct.pack("<HHHHLL", 0x0600, 0x0010, 0, 0, 0, 0))
    if dimensions:
        out += record(0x0200, struct.pack("<LLHHH", *dimensions, 0))
    for (row, col), value in sorted(cells.items()):
        value, xf = value if isinstance(value, tuple) else (value, 0)
        at = struct.pack("<HHH", row, col, xf)
        if isinstance(value, bytes):
            out += value
        elif isinstance(value, bool):
            out += record(0x0205, at + bytes([value, 0]))
        elif isinstance(value, str) and value.startswith("="):
            out += record(0x0006, at + b"\0\0\0\0\0\0\xff\xff" + b"\0" * 6) + record(0x0207, text(value[1:]))
        elif isinstance(value, str) and value in strings:
            out += record(0x00FD, at + struct.pack("<L", strings.index(value)))
        elif isinstance(value, str):
            out += record(0x0204, at + text(value))
        elif isinstance(value, int):
            out += record(0x027E, at + struct.pack("<l", value << 2 | 2))
        else:
            out += record(0x0203, at + struct.pack("<d", value))
    return out + record(0x000A)


def stream(sheets, strings=(), formats=(), cut=None, version=0x0600, extra=b""):
    """sheets: {name: bytes of sheet()}; formats: codes of XF 1 and so on."""
    head = record(0x0809, struct.pack("<HHHHLL", version, 0x0005, 0, 0, 0, 0)) + extra
    for i, code in enumerate(formats):
        head += record(0x041E, struct.pack("<H", 164 + i) + text(code))
    for f in (0, *(164 + i for i in range(len(formats)))):
        head += record(0x00E0, struct.pack("<HH", 0, f) + b"\0" * 16)
    tail = (shared(list(strings), cut) if strings else b"") + record(0x000A)
    names = [text(n, 1) for n in sheets]
    at = len(head) + sum(4 + 6 + len(n) for n in names) + len(tail)
    bound = b""
    for name, body in zip(names, sheets.values(), strict=True):
        bound += record(0x0085, struct.pack("<LBB", at, 0, 0) + name)
        at += len(body)
    return head + bound + tail + b"".join(sheets.values())


def compound(data, small=False):
    """A compound file of one stream; small: in sectors of 64 bytes, as streams below 4096 bytes are."""
    sector = 512
    pad = lambda b, n: b + b"\0" * (-len(b) % n)
    length = len(data)
    if not small:
        length = max(length, 4096)
        data = data + b"\0" * (length - len(data))
    body = pad(data, sector)
    n = len(body) // sector
    entry = lambda name, kind, start, size: pad(name.encode("utf-16-le") + b"\0\0", 64)[:64] + struct.pack("<HBB", 2 * len(name) + 2, kind, 1) + b"\xff" * 12 + b"\0" * 36 + struct.pack("<LLL", start, size, 0)
    # Sectors: FAT, directory, mini FAT, then the stream, backwards where it is large, so that its chain isn't its order.
    chain = list(range(3, 3 + n)) if small else list(range(2 + n, 2, -1))
    fat = [0xFFFFFFFD, 0xFFFFFFFE, 0xFFFFFFFE] + [0] * n
    for a, b in zip(chain, [*chain[1:], 0xFFFFFFFE], strict=True):
        fat[a] = b
    assert len(fat) <= sector // 4
    fat += [0xFFFFFFFF] * (sector // 4 - len(fat))
    minis = -(-length // 64)
    mini = [*range(1, minis), 0xFFFFFFFE] if small else []
    mini += [0xFFFFFFFF] * (sector // 4 - len(mini))
    root = entry("Root Entry", 5, chain[0] if small else 0xFFFFFFFE, len(body) if small else 0)
    folder = pad(root + entry("Workbook", 2, 0 if small else chain[0], length), sector)
    head = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1" + b"\0" * 16 + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + b"\0" * 6 + struct.pack("<LLLLLLLLL", 0, 1, 1, 0, 4096, 2, 1, 0xFFFFFFFE, 0) + struct.pack("<109L", 0, *[0xFFFFFFFF] * 108)
    sectors = [b""] * n
    for k, s in enumerate(chain):
        sectors[s - 3] = body[k * sector : (k + 1) * sector]
    return head + struct.pack("<128L", *fat) + folder + struct.pack("<128L", *mini) + b"".join(sectors)
