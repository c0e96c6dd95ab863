import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from hirelake.llm import secrets

from .conftest import ids_and_texts

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-])+)""", re.I | re.A)


def plain(text):
    """The base kinds, each pattern over the whole text."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found, key=lambda s: (s[0], secrets.ORDER[s[2]]))


def checked(prefix, body):
    value, check = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        check = secrets._DIGITS[d] + check
    return prefix + body + check


PARTS = st.sampled_from(
    ["password", "PassWord", "paſſword", "token", "api_key", "apikey", "secret", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "é", "🙂", "x", "longvalue1", "\n", "passwd"]
)


@settings(max_examples=500, deadline=None)
@given(st.lists(PARTS, max_size=20))
def test_base_spans(parts):
    text = "".join(parts)
    assert [s for s in secrets.scan_text(text) if s[2] in secrets.BASE_KINDS] == plain(text)


def test_checksums():
    good = checked("ghp_", "a1" * 15)
    assert secrets.scan_text(f"é {good}.") == [(2, 42, "code_host")]
    assert secrets.scan_text(good[:-1] + ("0" if good[-1] != "0" else "1")) == []
    assert secrets.scan_text(checked("npm_", "Zz" * 15)) == [(0, 40, "package_host")]
    assert [s[2] for s in secrets.scan_text("token=" + good)] == ["assign", "code_host"]


def test_redact():
    text = "a token=12345678, b"
    assert secrets.redact(text, secrets.scan_text(text)) == "a [assign], b"
    assert secrets.redact("abcdef", [(1, 4, "x"), (2, 5, "y")]) == "a[x]f"


def test_table(odd, empty):
    out = Counter((r["doc_id"], tuple(map(tuple, r["spans"]))) for r in secrets.find_secrets(odd).collect())
    assert out == Counter((d, tuple(plain(t))) for d, t in ids_and_texts(odd))
    assert secrets.find_secrets(empty).count() == 0
