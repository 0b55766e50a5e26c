"""Column-wise decoding of point files against one file at a time."""

import struct

import numpy as np
import pytest

from markfield.sources.annotations import decode_columns
from tests.support import point_file


def one(data):
    """Problem, or sub-pixel flag and places, of a single file."""
    if not data:
        return "empty_file"
    if len(data) < 64 or data[:4] != b"Iout":
        return "not_an_imagej_roi"
    if data[6] != 10:
        return "not_a_point_roi"
    page, second = struct.unpack(">ii", data[56:64])
    pages = [page, *(struct.unpack(">ii", data[second + 8:second + 16]) if 0 < second <= len(data) - 16 else ())]
    if max(pages) > 1:
        return "roi_refers_to_another_page"
    count = struct.unpack(">H", data[16:18])[0] or struct.unpack(">i", data[18:22])[0]
    exact = struct.unpack(">h", data[4:6])[0] >= 222 and bool(struct.unpack(">H", data[50:52])[0] & 128)
    if count <= 0:
        return "invalid_point_coordinates"
    kind, at, step = ("f", 64 + 4 * count, 4) if exact else ("h", 64, 2)
    if len(data) < at + 2 * count * step:
        return "decode_error"
    values = struct.unpack(f">{2 * count}{kind}", data[at:at + 2 * count * step])
    top, left = struct.unpack(">hh", data[8:12])
    xs, ys = (np.array(part, float) + (0 if exact else corner) for part, corner in ((values[:count], left), (values[count:], top)))
    return (exact, xs.tolist(), ys.tolist()) if np.isfinite([*xs, *ys]).all() else "invalid_point_coordinates"


def drawn(seed, number):
    rng = np.random.default_rng(seed)
    files = [b"", b"Iout", b"x" * 80]
    for n in range(number):
        data = bytearray(point_file(rng.uniform(-50, 900, (rng.integers(0, 9), 2)).round(2), f"f{n}", subpixel=bool(n % 2)))
        for _ in range(rng.integers(0, 3)):
            data[rng.choice([0, 4, 5, 6, 16, 17, 18, 21, 51, 59, 62, 63, int(rng.integers(len(data)))])] = rng.integers(256)
        if n % 11 == 0:
            data[64:68] = struct.pack(">f", float("nan"))
            data[68 + 2 * n % 40:72 + 2 * n % 40] = struct.pack(">f", float("inf"))
        files.append(bytes(data[:rng.integers(len(data) + 1)] if n % 7 == 0 else data))
    return files


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_one_at_a_time(seed):
    files = drawn(seed, 1_500)
    lengths = np.array([len(data) for data in files])
    ends = np.cumsum(lengths)
    problem, exact, count, xs, ys = decode_columns(np.frombuffer(b"".join(files), np.uint8), ends - lengths, lengths)
    till = np.cumsum(count)
    kinds = set()
    for n, data in enumerate(files):
        want = one(data)
        here = slice(till[n] - count[n], till[n])
        got = problem[n] or (bool(exact[n]), xs[here].tolist(), ys[here].tolist())
        assert got == want
        kinds.add(want if isinstance(want, str) else want[0])
    assert kinds == {"empty_file", "not_an_imagej_roi", "not_a_point_roi", "roi_refers_to_another_page", "invalid_point_coordinates",
                     "decode_error", True, False}


def test_no_files():
    assert [len(part) for part in decode_columns(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))] == [0] * 5
