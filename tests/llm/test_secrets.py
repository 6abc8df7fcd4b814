import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import zlib
from urllib.parse import quote

import pytest
import zstandard

from tests.llm.fixtures import SCHEMA, frame, mixed_rows
from tripstar.llm import secrets
from tripstar.llm.secrets import spans_of

KEY = "AKIA" + "ABCDEFGH12345678"


def brute_base(text):
    """The rules as written: leftmost matches, then those that are too short go."""
    out = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_base_rules_match_brute_force():
    pick = random.Random(1)
    bits = ["password", "PassWd", "api_key", "apikey", "token", "secret", "ſecret", ":", "=", " ", "'", '"', "abc", "abcdef12",
            "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "0123456789abcdef" * 2, "é", "x.y-z", "\n", "K"]
    for _ in range(4000):
        text = "".join(pick.choices(bits, k=pick.randint(0, 12)))
        assert spans_of(text)[0] == brute_base(text), text


@pytest.mark.parametrize("wrap", [
    lambda s: base64.b64encode(s.encode()).decode(),
    lambda s: base64.b64encode(base64.b64encode(s.encode())).decode(),
    lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    lambda s: base64.urlsafe_b64encode(quote(s, safe="").encode()).decode(),
    lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    lambda s: "".join(f"%{b:02x}" for b in gzip.compress(s.encode())),
    lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    lambda s: "".join(f"&#{ord(c)};" for c in s),
    lambda s: quote("".join(f"\\x{ord(c):02x}" for c in s), safe="")])
def test_hidden_layers_map_to_the_text(wrap):
    hidden = wrap(KEY)
    text = f"one two é {hidden} three"
    base, every, layers = spans_of(text)
    assert base == [] and layers >= 1
    assert (10, 1, 10 + len(hidden)) in every


def b64(data):
    return base64.b64encode(data).decode()


def wrapped(data, width, end="\n"):
    text = b64(data)
    return end.join(text[i:i + width] for i in range(0, len(text), width))


@pytest.mark.parametrize("hidden", [
    b64(KEY.encode("utf-16")), b64(KEY.encode("utf-16-be")), b64(b"x" + KEY.encode("utf-16-le")), b64(KEY.encode("utf-32-le")),
    b64(b"\x1b[0m " + KEY.encode() + b" \0"), b64(b"caf\xe9 " + KEY.encode()), "%E9%20" + "".join(f"%{b:02X}" for b in KEY.encode()),
    "".join(f"%{b:02X}" for b in KEY.encode("utf-16-le")), b64(b"x^2 " + KEY.encode())])
def test_layers_that_are_not_plain_utf8(hidden):
    base, every, _ = spans_of(f"one {hidden} three")
    assert base == [] and {k for _, k, _ in every} == {1}
    assert all(4 <= s < e <= 4 + len(hidden) for s, _, e in every)


@pytest.mark.parametrize("width", [64, 76])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    ", "\\n"])
def test_wrapped_base64(width, end):
    for at in range(0, 100, 7):
        hidden = wrapped(b"a" * at + b" " + KEY.encode() + b" " + b"z" * 150, width, end)
        for before in ("", "some words\n", "-----BEGIN CERTIFICATE-----\n", "data:", "here\n\n"):
            text = f"{before}{hidden}\nbye"
            base, every, _ = spans_of(text)
            assert base == [] and any(text[s:e] in hidden for s, k, e in every if k == 1), (at, before)
    noise = random.Random(3).randbytes(2000)
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress):
        hidden = wrapped(pack(noise + b" " + KEY.encode() + b" "), width, end)
        assert (4, 1, 4 + len(hidden.rstrip("="))) in spans_of(f"one\n{hidden}")[1]


def test_wrapped_secret_takes_its_lines_only():
    lines = [b64(bytes([110 + i]) * 48) for i in range(4)]
    lines[2] = b64(f" {KEY} ".ljust(48).encode())
    assert spans_of("\n".join(lines))[1] == [(130, 1, 194)]


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_every_member_is_read(pack):
    hidden = b64(pack(b"nothing") + pack(b"") + pack(KEY.encode()))
    assert spans_of(hidden)[1] == [(0, 1, len(hidden.rstrip("=")))] or spans_of(hidden)[1] == [(0, 1, len(hidden))]
    hidden = b64(pack(b"nothing") + b"and " + KEY.encode())
    assert {k for _, k, _ in spans_of(hidden)[1]} == {1}


def test_large_layers_are_scanned_in_windows(monkeypatch):
    monkeypatch.setattr(secrets, "WINDOW", 4000)
    monkeypatch.setattr(secrets, "OVERLAP", 1000)
    for at in range(0, 30_000, 990):
        text = b" " * at + KEY.encode() + b" " * (30_000 - at)
        for pack in (gzip.compress, bz2.compress, lambda x: gzip.compress(zstandard.compress(x))):
            assert {k for _, k, _ in spans_of(b64(pack(text)))[1]} == {1}, at


def test_layer_past_64_mb():
    hidden = b64(gzip.compress(b" " * (65 << 20) + KEY.encode(), 1))
    assert {k for _, k, _ in spans_of(hidden)[1]} == {1}


def test_partly_escaped_secret_keeps_exact_places():
    base, every, _ = spans_of("x pass%77ord=abcd%65f1 y")
    assert base == [] and every == [(2, 0, 22)]


def test_cycles_and_plain_text_end():
    again = base64.b64encode(b"plain words only here").decode()
    assert spans_of(again * 2)[1] == []
    assert spans_of("%25" * 500 + "41")[1] == []
    assert spans_of("")[1] == [] and spans_of("100% of %zz &#; \\u12")[1] == []


def test_scan_rows(spark):
    rows = [(1, f"key {KEY}"), (2, None), (3, ""), (None, "token=abcdef"), (1, f"key {KEY}")] + mixed_rows()
    got = secrets.scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    one = [r for r in got if r.doc_id == 1 and r.n_access]
    assert len(one) == 2 and one[0].spans == "access:4:24"
    assert one[0].base_sha256 == hashlib.sha256(b"access:4:24").hexdigest()
    assert secrets.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_redact_keeps_rows_and_columns(spark):
    df = frame(spark, [(1, f"key {KEY} end"), (2, None), (3, "clean text")])
    out = secrets.redact(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "key [access] end", 2: None, 3: "clean text"}


@pytest.mark.parametrize("text", [r"\U00000070assword=abcdefg", r"\u{70}assword=abcdefg", "%u0070assword=abcdefg", r"\160assword=abcdefg",
                                  "pass&#119;ord&equals;abcdefg", "pass&#x77;ord&colon; abcdefg"])
def test_forms_of_escapes(text):
    assert spans_of(f"an {text} here")[1] == [(3, 0, 3 + len(text))]


def test_what_only_looks_like_an_escape():
    for text in (r"C:\777 \U99999999 \u{fffffff} &nosuchname; AT&T", "&amp &;"):
        assert spans_of(text)[1] == []


def test_a_secret_in_one_line_of_base64_is_masked_alone():
    body = b"ordinary words, " * 300 + b"password=hunter22 " + b"and more of them " * 30
    text = f"a {b64(body)} b"
    [(start, kind, end)] = spans_of(text)[1]
    assert kind == 0 and (start - 2) % 4 == 0 and b"password=hunter22" in base64.b64decode(text[start:end]) and end - start <= 28
