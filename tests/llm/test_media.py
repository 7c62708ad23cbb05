import hashlib
import time
import zlib

import numpy as np
import pytest

from millrace.llm import jpeg, media


@pytest.mark.parametrize("size", [64, 128, 384, 448, 64 * 1000, 64 * 40_000])
def test_payload_round_trip(size):
    rng = np.random.default_rng(size)
    for data in (rng.integers(0, 256, size, np.uint8).tobytes(), bytes(size), b"\xff" * size):
        stored = jpeg.encode_payload(data, b"x=%d" % size)
        image = jpeg.decode(stored)
        assert jpeg.payload_of(image, size) == data and jpeg.noted(image.comment) == {"x": size}
        if size < 100_000:
            slow = jpeg.decode(stored, plain=True)
            assert all((a.coef == b.coef).all() for a, b in zip(image.comps, slow.comps))
            assert (image.rgb() == slow.rgb()).all() and image.rgb().shape == (image.height, image.width, 3)


def bits_of(parts):
    return "".join(f"{v:0{n}b}" for v, n in parts if n)


def to_bytes(bits):
    bits += "1" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")


def grey(coef, across, down, scans, interval=0):
    """A plain progressive writer for tests: any coefficients, one component, codes of eight bits for every symbol."""
    symbols = bytes(range(255))
    table = bytes([0] * 7 + [255] + [0] * 8) + symbols
    out = b"\xff\xd8" + jpeg._segment(0xDB, b"\0" + bytes([3] * 64)) + jpeg._segment(0xC4, b"\x00" + table + b"\x10" + table)
    out += jpeg._segment(0xC2, bytes([8]) + (down * 8 - 3).to_bytes(2, "big") + (across * 8 - 5).to_bytes(2, "big") + bytes([1, 1, 0x11, 0]))

    def value(v):
        n = abs(v).bit_length()
        return (v if v >= 0 else v + (1 << n) - 1, n)

    def down_by(v, low):
        return (abs(v) >> low) * (1 if v > 0 else -1)

    def coded(coef, ss, se, high, low):
        parts = []
        if ss == 0 and not high:
            last = 0
            for b in coef:
                v, n = value((b[0] >> low) - last)
                parts += [(n, 8), (v, n)]
                last = b[0] >> low
        elif ss == 0:
            parts = [((b[0] >> low) & 1, 1) for b in coef]
        else:
            run, held = 0, []  # blocks at their end of band and their correction bits
            def flush():
                nonlocal run, held, parts
                if run:
                    r = run.bit_length() - 1
                    parts += [(r << 4, 8), (run - (1 << r), r), *held]
                run, held = 0, []
            for b in coef:
                now = [down_by(int(b[k]), low) for k in range(ss, se + 1)]
                old = [down_by(int(b[k]), high) if high else 0 for k in range(ss, se + 1)]
                new = [i for i in range(len(now)) if now[i] and not old[i]]
                zeros, fix, i = 0, [], 0
                for i in range((new[-1] + 1) if new else 0):
                    if old[i]:
                        fix.append((abs(now[i]) & 1, 1))
                    elif not now[i]:
                        zeros += 1
                        if zeros == 16:
                            flush()
                            parts += [(0xF0, 8), *fix]
                            zeros, fix = 0, []
                    else:
                        flush()
                        if high:
                            parts += [(zeros << 4 | 1, 8), (int(now[i] > 0), 1), *fix]
                        else:
                            v, n = value(now[i])
                            parts += [(zeros << 4 | n, 8), (v, n)]
                        zeros, fix = 0, []
                tail = (new[-1] + 1) if new else 0
                if tail < len(now):
                    run += 1
                    held = held + [(abs(now[i]) & 1, 1) for i in range(tail, len(now)) if old[i]]
                else:
                    pass
            flush()
        return to_bytes(bits_of(parts))

    if interval:
        out += jpeg._segment(0xDD, interval.to_bytes(2, "big"))
    for scan in scans:
        runs = [coded(coef[i : i + (interval or len(coef))], *scan) for i in range(0, len(coef), interval or len(coef))]
        out += jpeg._scan_head([1], *scan) + b"".join(r + (bytes([0xFF, 0xD0 + k % 8]) if k + 1 < len(runs) else b"") for k, r in enumerate(runs))
    return out + b"\xff\xd9"


def test_any_coefficients_by_any_script():
    rng = np.random.default_rng(3)
    coef = np.where(rng.random((12, 64)) < 0.25, rng.integers(-200, 200, (12, 64)), 0)
    coef[4, 1:] = 0
    coef[7, 1:] = 0
    coef[5, 63] = 9
    script = [(0, 0, 0, 2), (1, 5, 0, 2), (6, 63, 0, 3), (6, 63, 3, 2), (0, 0, 2, 1), (1, 63, 2, 1), (0, 0, 1, 0), (1, 63, 1, 0)]
    for interval in (0, 1, 5):
        image = jpeg.decode(grey(coef.tolist(), 4, 3, script, interval))
        assert (image.comps[0].coef.reshape(-1, 64) == coef).all()
    assert image.rgb().shape == (21, 27, 3)


def test_inverse_transform():
    image = jpeg.decode(grey([[40] + [0] * 63], 1, 1, [(0, 0, 0, 0), (1, 63, 0, 0)]))
    assert (image.rgb() == 128 + 15).all()  # 40 * 3 / 8
    assert np.allclose(jpeg.BASIS @ jpeg.BASIS.T, np.eye(64))


def test_rows(spark):
    rows = [(1, None), (2, ""), (3, "x" * 64), (4, "é" * 5000), (4, "é" * 5000), (None, "a\0b")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, media int")
    got = media.round_trip(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 6
    for i, t in rows:
        raw = (t or "").encode()
        pad = raw + bytes(64 - len(raw) % 64 if len(raw) % 64 or not raw else 0)
        r = by[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(pad), hashlib.sha256(pad).hexdigest(), zlib.crc32(pad[-64:]))
    assert by[1].feature == by[2].feature and by[1].media_sha256 == by[2].media_sha256
    assert media.round_trip(df.limit(0)).count() == 0
    t = {r.doc_id: r for r in media.decode_tensors(media.store_texts(df)).collect()}
    assert len(t[4].rgb) == t[4].height * t[4].width * 3
    bad = media.decode_tensors(spark.createDataFrame([(1, bytearray(b"no")), (2, None)], "doc_id long, media binary")).collect()
    assert [r.rgb for r in bad] == [None, None]


def test_damage_is_a_value_error(spark):
    """Cut, changed and senseless pictures raise ValueError and nothing else; rows of them give nulls."""
    rng = np.random.default_rng(0)
    good = [jpeg.encode_payload(bytes(range(256)) * 6, b"bytes=1 payload=1536"), grey([[40, 3] + [0] * 62] * 4, 2, 2, [(0, 0, 0, 0), (1, 63, 0, 0)], 2)]
    frame, head = jpeg._segment(0xC2, bytes([8, 0, 8, 0, 8, 1, 1, 0x11, 0])), jpeg._scan_head([1], 0, 0, 0, 0)
    bad = [b"", b"\xff\xd8", b"\xff\xd8" + head + b"\0", b"\xff\xd8" + jpeg._segment(0xC2, b"\x08\0"), b"\xff\xd8" + frame, b"\xff\xd8" + frame + frame]
    bad += [b"\xff\xd8" + jpeg._segment(0xC2, bytes([8, 0, 8, 0, 8, n, *[1, hv, 0] * n])) + head + b"\0" for n, hv in ((1, 0), (1, 0x10), (4, 0x11), (2, 0x11))]
    bad += [b"\xff\xd8" + jpeg._segment(0xC2, bytes([8, 255, 255, 255, 255, 1, 1, 0x11, 0])) + head + b"\0"]
    for data in good:
        bad += [data[:n] for n in range(3, len(data) - 2, 37)]
        for _ in range(300):
            own = bytearray(data)
            for at in rng.integers(2, len(own), 2):
                own[at] = rng.integers(0, 256)
            bad.append(bytes(own))
    seen = 0
    for data in bad:
        try:
            jpeg.decode(data).rgb()
        except ValueError:
            seen += 1
    assert seen > 100
    rows = media.decode_tensors(spark.createDataFrame([(k, bytearray(d)) for k, d in enumerate(bad[:11] + good)], "doc_id long, media binary")).orderBy("doc_id").collect()
    assert [r.rgb is None for r in rows] == [True] * 11 + [False, False]


def test_feature_is_of_the_tensor(spark):
    df = spark.createDataFrame([(1, "some text " * 900)], "doc_id long, text string")
    t = media.decode_tensors(media.store_texts(df)).first()
    x = np.frombuffer(t.rgb, np.uint8).reshape(t.height, t.width, 3).astype(float)
    want = f"{t.width}x{t.height} " + " ".join(f"{c}={x[..., k].mean():.3f}/{x[..., k].std():.3f}" for k, c in enumerate("rgb"))
    assert media.round_trip(df).first().feature == want
