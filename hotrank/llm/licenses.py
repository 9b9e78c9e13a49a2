"""License scans: notice phrases and identifier tags by Aho-Corasick, expressions by shunting-yard."""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from hotrank.llm.common import LOWER, UPPER, per_text, pick, read

# Phrase, label.
BASE_PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
NOTICE_PHRASES = (
    ("apache license", "apache"),
    ("mit license", "mit"),
    ("bsd license", "bsd"),
    ("mozilla public license", "mpl"),
    ("lesser general public license", "lgpl"),
    ("affero general public license", "agpl"),
    ("creative commons attribution", "cc-by-notice"),
    ("public domain", "public-domain"),
    ("permission is hereby granted free of charge", "permissive-grant"),
)
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:", "@license")
# Identifiers of the public licence list that have no family of versions, by how
# free their terms leave the reader, 0 to 1; and families with their versions.
_SINGLE = {
    1.0: "0BSD MIT MIT-0 ISC Unlicense Zlib WTFPL NCSA X11 curl PostgreSQL BSL-1.0 CC0-1.0 Libpng "
    "BlueOak-1.0.0 UPL-1.0 HPND ICU FTL Ruby TCL Vim Xnet Beerware OpenSSL Unicode-DFS-2016",
    0.6: "CDDL-1.0 CDDL-1.1 EPL-1.0 EPL-2.0 MPL-1.0 MPL-1.1 MPL-2.0 MPL-2.0-no-copyleft-exception "
    "CPL-1.0 IPL-1.0 MS-PL MS-RL Artistic-1.0 Artistic-2.0 ODbL-1.0 OFL-1.0 OFL-1.1",
    0.5: "EUPL-1.0 EUPL-1.1 EUPL-1.2 CECILL-2.0 CECILL-2.1 CECILL-C CECILL-B OSL-3.0 Sleepycat QPL-1.0",
    0.2: "SSPL-1.0 RPL-1.5",
    0.1: "BUSL-1.1 Elastic-2.0 PolyForm-Noncommercial-1.0.0",
    0.0: "proprietary",
}
_FAMILIES = (
    (1.0, "Apache", "1.0 1.1 2.0"), (1.0, "BSD", "1-Clause 2-Clause 3-Clause 4-Clause"),
    (1.0, "AFL", "1.1 1.2 2.0 2.1 3.0"), (1.0, "ZPL", "1.1 2.0 2.1"), (1.0, "PHP", "3.0 3.01"),
    (1.0, "Python", "2.0 2.0.1"), (1.0, "PSF", "2.0"), (1.0, "ECL", "1.0 2.0"),
)
_GNU = ((0.5, "LGPL", "2.0 2.1 3.0"), (0.3, "GPL", "1.0 2.0 3.0"), (0.3, "GFDL", "1.1 1.2 1.3"),
        (0.2, "AGPL", "1.0 3.0"))
_CREATIVE = ((0.9, "CC-BY"), (0.5, "CC-BY-SA"), (0.3, "CC-BY-ND"), (0.1, "CC-BY-NC"),
             (0.1, "CC-BY-NC-SA"), (0.1, "CC-BY-NC-ND"))


def _identifiers() -> dict[str, float]:
    """How free each identifier, in lower case, leaves the reader."""
    found = {x.lower(): free for free, names in _SINGLE.items() for x in names.split()}
    for free, name, versions in _FAMILIES:
        found |= {f"{name}-{v}".lower(): free for v in versions.split()}
    for free, name, versions in _GNU:
        for v in versions.split():
            # The bare and the plus form are deprecated, not gone.
            found |= {f"{name}-{v}{end}".lower(): free for end in ("", "-only", "-or-later")}
    for free, name in _CREATIVE:
        found |= {f"{name}-{v}".lower(): free for v in ("1.0", "2.0", "2.5", "3.0", "4.0")}
    return found


IDENTIFIERS = _identifiers()
EXCEPTIONS = set(
    "classpath-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 llvm-exception font-exception-2.0 "
    "autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception "
    "linux-syscall-note openvpn-openssl-exception qt-gpl-exception-1.0 qt-lgpl-exception-1.1 "
    "swift-exception u-boot-exception-2.0 wxwindows-exception-3.1 universal-foss-exception-1.0".split()
)
#: How sure a label makes us that the text carries a licence; expressions count fully.
_SURE = {"reserved": 0.5, "public-domain": 0.5}
_PHRASE_SURE = 0.9

_TOKEN = re.compile(
    r"[ \t]*([()]|DocumentRef-[A-Za-z0-9.-]+:LicenseRef-[A-Za-z0-9.-]+|[A-Za-z0-9][A-Za-z0-9.+-]*)", re.I)
#: What an operand nobody knows must look like, after an operator in small letters or at the start.
_FORMAL = re.compile(r"(?=.*[0-9-])[a-z][a-z0-9.+-]*")
_BINDS = {"or": 1, "and": 2, "with": 3}
#: Lower-cases A-Z and turns what is not part of a word into blanks.
_WORDS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if b in UPPER else 0x20
    for b in range(256)
)


def _kind(token: str, exception: bool) -> str:
    """``id`` of what the lists know (a plus means: or a later version), else ``unknown``."""
    if exception:
        known = token in EXCEPTIONS
    else:
        known = token.removesuffix("+") in IDENTIFIERS or token.startswith(
            ("licenseref-", "documentref-"))
    return "id" if known else "unknown"


def parse(text: str, at: int = 0) -> list[tuple[str, str]] | None:
    """The longest licence expression that starts at ``at``, in postfix order.

    Gives pairs of kind (``id``, ``unknown``, ``op``) and lower-case token. An operand that no list
    has stays in the tree as unknown where it is meant as one: after an operator in capitals, or
    when it has a digit or a hyphen as identifiers do. Ends before the first token that does not
    go on, or at a full stop; operators left without a second operand are left out. Empty without
    any known identifier; None when parentheses stay open.
    """
    output: list[tuple[str, str]] = []
    stack: list[tuple[str, int]] = []
    wants, done, depth = True, 0, 0
    last, loud = "", False
    while m := _TOKEN.match(text, at):
        word = m[1] if m[1] in "()" else m[1].rstrip(".-")
        token = word.lower()
        if wants:
            kind = _kind(token, last == "with")
            if token == "(" and last != "with":
                stack.append(("(", done))
                depth += 1
            elif token not in ("(", ")", *_BINDS) and (
                kind == "id" or loud or _FORMAL.fullmatch(token)
            ):
                output.append((kind, token))
                wants, done = False, done + 1
            else:
                break
        elif token in _BINDS:
            while stack and stack[-1][0] != "(" and _BINDS[stack[-1][0]] >= _BINDS[token]:
                output.append(("op", stack.pop()[0]))
            stack.append((token, done))
            wants, loud = True, word.isupper()
        elif token == ")" and depth:
            while stack[-1][0] != "(":
                output.append(("op", stack.pop()[0]))
            stack.pop()
            depth -= 1
        else:
            break
        last, at = token, m.start(1) + len(word)
    if not any(kind == "id" for kind, _ in output):
        return []
    if depth:
        return None
    while stack:
        token, before = stack.pop()
        if token != "(" and before < done:
            output.append(("op", token))
    return output


def freedom(postfix: list[tuple[str, str]]) -> float:
    """The reader may choose among ``or``, must keep all of ``and``; ``with`` adds a permission.

    What is unknown grants nothing, and terms changed by an unknown exception are unknown.
    """
    values: list[float] = []
    for kind, token in postfix:
        if kind == "op":
            right, left = values.pop(), values.pop()
            if token == "with":
                values.append(min(1.0, left + 0.2) if right else 0.0)
            else:
                values.append(max(left, right) if token == "or" else min(left, right))
        elif kind == "id":
            values.append(1.0 if token in EXCEPTIONS else IDENTIFIERS.get(token.removesuffix("+"), 0.0))
        else:
            values.append(0.0)
    return values[0]


def _scanner(base, notices, tags):
    phrases = ahocorasick.Automaton()
    by_text: dict[str, tuple[int, set, set]] = {}
    for group, is_base in ((base, True), (notices, False)):
        for phrase, label in group:
            key = f" {phrase} "
            size, own, more = by_text.setdefault(key, (len(key), set(), set()))
            (own if is_base else more).add(label)
    for key, found in by_text.items():
        phrases.add_word(key, found)
    phrases.make_automaton()
    tagged = ahocorasick.Automaton()
    for tag in tags:
        tagged.add_word(tag, tag)
    tagged.make_automaton()


    def scan(raw: bytes):
        words = raw.translate(_WORDS).split()
        joined = f" {b' '.join(words).decode()} "
        n_base, first, last, own, more = 0, None, None, set(), set()
        counted, seen = 0, -1
        for end, (size, base_labels, labels) in sorted(
            (end - x[0], x) for end, x in phrases.iter(joined)
        ) if words else ():
            if base_labels:
                # The match starts at the blank before its first word.
                seen += joined.count(" ", counted, end + 2)
                counted = end + 2
                n_base += len(base_labels)
                first = seen if first is None else first
                last = seen
                own |= base_labels
            more |= labels
        expressions, free = [], []
        whole = raw.decode()
        low = raw.translate(LOWER).decode()
        for end, _ in tagged.iter(low) if low else ():
            postfix = parse(whole, end + 1)
            if postfix is None:
                more.add("expression-invalid")
            elif postfix:
                expressions.append(" ".join(token for _, token in postfix))
                free.append(freedom(postfix))
                more |= {f"spdx:{token}" for kind, token in postfix if kind == "id"}
                more |= {f"spdx-unknown:{token}" for kind, token in postfix if kind == "unknown"}
        doubt = 1.0
        for label in sorted(own | more):
            doubt *= 1 - (1.0 if label[:5] == "spdx:" else _SURE.get(label, _PHRASE_SURE))
        return (
            len(words), n_base, first, last, ",".join(sorted(own)), ",".join(sorted(own | more)),
            1 - doubt, expressions, min(free, default=None),
        )

    return scan


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base=BASE_PHRASES,
    notices=NOTICE_PHRASES,
    tags=TAGS,
) -> DataFrame:
    """Licence notices and expressions of every whole text; one row per row of ``docs``.

    A phrase counts wherever its words stand consecutively, overlaps included. After a tag the
    longest licence expression is parsed by shunting-yard and evaluated: ``freedom`` is the least
    of the text's expressions, null without one; operands in no list are labelled ``spdx-unknown:``
    and grant nothing. ``score`` is 1 less the product of what each
    label leaves open. Null and empty texts: no words, labels empty, score 0. Repeated rows give
    repeated rows, an empty table none, and texts are read whole however long. No shuffle; a task holds one slice of texts.
    """
    return per_text(
        pick(docs, doc_id=id_col, text=text_col),
        "n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, expressions array<string>, freedom double",
        lambda: _scanner(base, notices, tags),
    )


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(read(spark, folder, "documents"))
