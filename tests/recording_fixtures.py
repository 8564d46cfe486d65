"""Hand-made cfg/dat pairs in the published recording format (tests only).

Each builder returns ``(cfg_text, dat_bytes)``.  Values are chosen so the
decoded physical values are exact in binary floating point.
"""

from __future__ import annotations

import struct

START = "01/01/2024,00:00:00.000000"
TRIGGER = "01/01/2024,00:00:00.020000"


def cfg_text(analog, status=(), file_type="ASCII", rates=(), time_mult="1",
             station="ST1", device="D7", newline="\n", final_newline=True,
             frequency="60") -> str:
    """analog: [(name, phase, unit, a, b)], status: [name]."""
    lines = [f"{station},{device},1999",
             f"{len(analog) + len(status)},{len(analog)}A,{len(status)}D"]
    for j, (name, ph, unit, a, b) in enumerate(analog, 1):
        lines.append(f"{j},{name},{ph},I,{unit},{a},{b},0,-500,500,1,1,P")
    for k, name in enumerate(status, 1):
        lines.append(f"{k},{name},,,0")
    lines.append(frequency)
    lines.append(str(len(rates)))
    if rates:
        lines += [f"{r},{e}" for r, e in rates]
    else:
        lines.append("0,4")
    lines += [START, TRIGGER, file_type, time_mult]
    text = newline.join(lines)
    return text + newline if final_newline else text


PHASES3 = [("IA", "A", "A", 0.5, 0.0), ("IB", "B", "A", 0.5, 0.0), ("IC", "C", "A", 0.5, 0.0)]
# counts per sample (n, t_us, IA, IB, IC)
SAMPLES = [(1, 0, 2, -4, 6), (2, 1000, -8, 10, -12), (3, 2000, 14, -16, 18), (4, 3000, -20, 22, -24)]


def ascii_dat(rows, newline="\n", final_newline=True) -> bytes:
    text = newline.join(",".join("" if v is None else str(v) for v in r) for r in rows)
    return (text + (newline if final_newline else "")).encode()


def binary_dat(rows, n_analog, status_words=0, kind="<h") -> bytes:
    out = b""
    for r in rows:
        n, t, *rest = r
        a = rest[:n_analog]
        w = rest[n_analog:n_analog + status_words]
        out += struct.pack("<II", n, t)
        out += struct.pack("<" + kind[1:] * n_analog, *[-32768 if v is None else v for v in a])
        out += struct.pack("<" + "H" * status_words, *w)
    return out


def ascii_3a():
    return cfg_text(PHASES3), ascii_dat(SAMPLES)


def ascii_crlf():
    return (cfg_text(PHASES3, newline="\r\n", final_newline=False),
            ascii_dat(SAMPLES, newline="\r\n", final_newline=False))


def binary_3a():
    return cfg_text(PHASES3, file_type="BINARY"), binary_dat(SAMPLES, 3)


def binary_status():
    names = [f"S{k}" for k in range(1, 18)]
    rows = []
    for n, t, a, b, c in SAMPLES:
        # bit k of word 0 set when k < n; bit 0 of word 1 (channel 17) set on odd n
        w0 = (1 << n) - 1
        w1 = n % 2
        rows.append((n, t, a, b, c, w0, w1))
    return cfg_text(PHASES3, status=names, file_type="BINARY"), binary_dat(rows, 3, status_words=2)


def no_analog():
    rows = [(1, 0, 1), (2, 1000, 0)]
    return cfg_text([], status=["TRIP"]), ascii_dat(rows)


def no_status():
    return ascii_3a()


def reordered():
    analog = [PHASES3[2], PHASES3[0], PHASES3[1]]   # IC, IA, IB
    rows = [(n, t, c, a, b) for n, t, a, b, c in SAMPLES]
    return cfg_text(analog), ascii_dat(rows)


def missing_phase():
    rows = [(n, t, a, b) for n, t, a, b, _ in SAMPLES]
    return cfg_text(PHASES3[:2]), ascii_dat(rows)


def extra_channel():
    analog = PHASES3 + [("VA", "A", "V", 1.0, 0.0)]
    rows = [(n, t, a, b, c, 100 + n) for n, t, a, b, c in SAMPLES]
    return cfg_text(analog), ascii_dat(rows)


def duplicate_channel():
    analog = PHASES3 + [("IA", "A", "A", 0.5, 0.0)]
    rows = [(n, t, a, b, c, 999) for n, t, a, b, c in SAMPLES]
    return cfg_text(analog), ascii_dat(rows)


def rate_based():
    """Sample times from a 1 kHz rate; the time field is ignored."""
    rows = [(n, 0, a, b, c) for n, _, a, b, c in SAMPLES]
    return cfg_text(PHASES3, rates=[(1000, 4)]), ascii_dat(rows)


def expected_phases():
    """Physical values of SAMPLES: a = 0.5."""
    return [[a * 0.5, b * 0.5, c * 0.5] for _, _, a, b, c in SAMPLES]


EPOCH_2024_US = 1704067200000000


def multi_rate():
    """Two rates: samples 1-2 at 1 kHz, samples 3-4 at 500 Hz."""
    rows = [(n, 0, a, b, c) for n, _, a, b, c in SAMPLES]
    return cfg_text(PHASES3, rates=[(1000, 2), (500, 4)]), ascii_dat(rows)


def multi_rate_binary():
    rows = [(n, 0, a, b, c) for n, _, a, b, c in SAMPLES]
    return cfg_text(PHASES3, rates=[(1000, 2), (500, 4)], file_type="BINARY"), binary_dat(rows, 3)
