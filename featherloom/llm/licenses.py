"""License scan by conditional compression, confirmed by exact wording differences."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featherloom.llm.license_texts import TEMPLATES

# what a candidate line holds; the same pattern runs in Spark and in Python
SIGN = r"(?i)licen[sc]|copyright|all rights reserved|creative commons|public domain|permission is hereby|redistribut|\bcc0?[ -](by|1)"
LEVEL = 19
_SIGN, _WORD, _GAP = re.compile(SIGN), re.compile(r"[\w<>]+"), re.compile(r"<\w+>$")


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


@dataclass(frozen=True)
class Match:
    license: str
    template: int
    start: int  # code points in the text, end exclusive
    end: int
    plain: int  # compressed size alone and with the template as dictionary
    given: int
    differences: tuple[str, ...]


class Scanner:
    """Templates with their compressors. A confirmed block differs from its template in few words, and in none with a digit or capital code."""

    def __init__(self, templates: dict[str, list[str]] = TEMPLATES, most: float = 0.15):
        self.most = most
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.known = []
        self.longest = max(len(t) for texts in templates.values() for t in texts)
        for name, texts in templates.items():
            for i, text in enumerate(texts):
                body = " ".join(words(text)).encode()
                held = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                self.known.append((name, i, words(text), zstandard.ZstdCompressor(level=LEVEL, dict_data=held)))
        self.vocabulary = {w for _, _, ws, _ in self.known for w in ws}
        # words that tell templates apart: a match may not miss or change one
        self.telling = {w for w in self.vocabulary if any(c.isdigit() for c in w)} | {
            "mit", "apache", "gnu", "lesser", "affero", "mozilla", "bsd", "by", "sa", "nc", "nd", "sharealike", "noncommercial"}

    def blocks(self, text: str) -> list[tuple[int, int]]:
        """Runs of lines that may hold a notice: lines with a sign, and around them lines written in the templates' words."""
        found, at = [], 0
        lines = []
        for line in text.split("\n"):
            lines.append((at, at + len(line), line))
            at += len(line) + 1
        signs = [i for i, x in enumerate(lines) if _SIGN.search(x[2])]
        done = -1
        for i in signs:
            if i <= done:
                continue
            a = b = i
            while a - 1 > done and self._alike(lines[a - 1][2]):
                a -= 1
            while b + 1 < len(lines) and (_SIGN.search(lines[b + 1][2]) or self._alike(lines[b + 1][2])):
                b += 1
            found += self._near_signs(text, lines[a][0], lines[b][1])
            done = b
        return found

    def _near_signs(self, text: str, start: int, end: int) -> list[tuple[int, int]]:
        """A long block cut to what a notice with one of its signs can reach, overlapping parts joined."""
        reach, parts = 2 * self.longest, []
        if end - start <= 2 * reach:
            return [(start, end)]
        for m in _SIGN.finditer(text, start, end):
            a, b = max(start, m.start() - reach), min(end, m.end() + reach)
            while start < a and text[a - 1].isalnum():
                a -= 1
            while b < end and text[b].isalnum():
                b += 1
            if parts and a <= parts[-1][1]:
                parts[-1] = (parts[-1][0], b)
            else:
                parts.append((a, b))
        return parts

    def _alike(self, line: str) -> bool:
        ws = words(line)
        return sum(w in self.vocabulary for w in ws) >= 0.8 * len(ws)

    def rank(self, block: str) -> list[tuple[float, int, int, int]]:
        """(relative size reduction, template, size alone, size given the template), largest reduction first."""
        body = " ".join(words(block)).encode()
        alone = len(self.plain.compress(body))
        sizes = [len(c.compress(body)) for _, _, _, c in self.known]
        return sorted(((alone - n) / alone, -k, alone, n) for k, n in enumerate(sizes))[::-1]

    def confirm(self, block: str, template: list[str]) -> tuple[int, int, tuple[str, ...]] | None:
        """Where the template's wording stands in the block and how it differs, or None if it differs in too much or in a telling word."""
        spots = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(block)]
        have = [s[0] for s in spots]
        matcher = SequenceMatcher(None, template, have, autojunk=False)
        same = [b for b in matcher.get_matching_blocks() if b.size]
        if not same:
            return None
        lo, hi = same[0].b, same[-1].b + same[-1].size
        differences, cost = [], 0
        for op, i, j, k, n in matcher.get_opcodes():
            k, n = max(k, lo), min(n, hi)
            gone = template[i:j] if op in ("delete", "replace") else []
            new = have[k:n] if op in ("insert", "replace") and n > k else []
            if op == "equal" or not (gone or new):
                continue
            if gone and all(_GAP.match(w) for w in gone):
                continue  # words that differ from notice to notice
            if self.telling & {*gone, *new}:
                return None
            cost += max(len(gone), len(new))
            differences.append(f"-{' '.join(gone)}+{' '.join(new)}")
        if cost > self.most * len(template):
            return None
        return spots[lo][1], spots[hi - 1][2], tuple(differences)

    def search(self, text: str | None) -> list[Match]:
        """Confirmed notices of a text. A block may hold several: what a match covers is cut out and the rest is tried again."""
        found: list[Match] = []
        pending = self.blocks(text) if text and _SIGN.search(text) else []
        while pending:
            a, b = pending.pop()
            block = text[a:b]
            if not words(block) or not _SIGN.search(block):
                continue
            best = None
            for gain, minus, alone, given in self.rank(block):
                if gain <= 0:
                    break
                name, i, template, _ = self.known[-minus]
                hit = self.confirm(block, template)
                if hit and (best is None or (len(template) - len(hit[2]), gain) > best[0]):
                    best = ((len(template) - len(hit[2]), gain), Match(name, i, a + hit[0], a + hit[1], alone, given, hit[2]))
            if best:
                found.append(best[1])
                pending += [(a, best[1].start), (best[1].end, b)]
        return sorted(found, key=lambda m: (m.start, m.end))


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """One row per notice found: doc_id, license, start, end (code points), size_alone, size_given, differences (-template+text wording).

    Candidate blocks are the lines with a licensing word and neighbouring lines in the templates' vocabulary. Every template that shrinks
    a block when it serves as raw zstandard dictionary is tried by size reduction, and the one whose exact wording explains most words wins;
    telling words (versions, names, terms) must agree. Null and empty texts have no notice, repeated rows are found each. Rows without a sign
    leave in Spark's filter; nothing is shuffled.
    """
    kind = docs.select("doc_id").schema.fields[0]
    schema = T.StructType([kind, T.StructField("license", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                           T.StructField("size_alone", T.IntegerType()), T.StructField("size_given", T.IntegerType()),
                           T.StructField("differences", T.ArrayType(T.StringType()))])
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for b in batches:
            rows, at = [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                for m in scanner.search(text):
                    rows.append((m.license, m.start, m.end, m.plain, m.given, list(m.differences)))
                    at.append(i)
            cols = [pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(at, pa.int64())), *cols], names=schema.names)

    signed = docs.select("doc_id", "text").where(F.rlike("text", F.lit(SIGN)))
    return signed.mapInArrow(run, schema)
