"""License scans by conditional compression.

The words around each license word, as far as a template of that length can
reach, are its candidate block.  The block's wording is compressed alone and
with the template's as a zstandard raw dictionary, with the same parameters.
A template is a candidate if it makes its block smaller by at least a share of
what it saves of its own wording; candidates are ranked by the bytes saved, and
the first whose wording is confirmed wins: the words in which the passage
around the license word differs from it are few enough, and none of them names
a version or a license.  The winner's words are taken out, and the search goes
on from the next license word behind them.
"""

from __future__ import annotations

import re
from collections import deque
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import ship_by_value

# FIXED VALUES: public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:"),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.\n\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "BSD-2-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:\n\n"
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.\n\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies.\n\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
        "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
        "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
}
TRIGGER = r"(?i)licen[sc]|copyright|all rights reserved|permission is|warrant(?:y|ies)|redistribut"
LEVEL = 12
#: Of a template's words, this share may differ (short notices: none).
MAX_DIFFERENT = 0.05
#: A candidate saves at least this share of what its template saves of itself (a notice
#: between other words saves over 0.4 of it in the least of 300 places a template).
LEAST_SAVED = 0.2
#: Words compressed, or aligned, at once.
PIECE = 1024
#: Blocks whose savings a worker remembers (copies of a notice are scored once).
BLOCKS_KEPT = 1 << 14
WORD = re.compile(r"\w+(?:[-.]\w+)*")


def wording(text: str) -> list[str]:
    return WORD.findall(text.lower())


def align(block: list[str], template: list[str]) -> tuple[int, int, list[str], list[str]]:
    """(first, end, missing, extra): the run of the block's words closest to
    the template, the template's words it lacks, and the words it has more."""
    at = np.arange(len(block) + 1)
    number = {w: k for k, w in enumerate(template)}
    own = np.array([number.get(w, -1) for w in block], np.int32)
    # costs[j][i]: j words of the template against some words of the block that end at i
    costs = np.zeros((len(template) + 1, len(at)), np.int32)
    for j, w in enumerate(template, 1):
        row = costs[j - 1] + 1
        np.minimum(row[1:], costs[j - 1][:-1], out=row[1:], where=own == number[w])
        costs[j] = np.minimum.accumulate(row - at) + at
    i, j, first, end, missing, extra = int(costs[-1].argmin()), len(template), 0, None, [], []
    while j:
        if i and block[i - 1] == template[j - 1]:
            i, j, first, end = i - 1, j - 1, i - 1, end or i
        elif not i or costs[j - 1][i] <= costs[j][i - 1]:
            j -= 1
            missing.append(template[j])
        else:
            i -= 1
            extra.append(block[i])
    return first, end or 0, missing[::-1], extra[::-1]


def naming_words(templates: dict[str, str]) -> set[str]:
    """Words that tell templates apart: any with a digit, and any that not all short notices share."""
    words = [set(wording(t)) for t in templates.values()]
    return {w for ws in words for w in ws if any(c.isdigit() for c in w)} | {
        w for ws in words for w in ws if len(ws) <= 12 and sum(w in o for o in words) < len(words) // 2}


class Scanner:
    def __init__(self, templates: dict[str, str]):
        import zstandard
        self.words = {k: wording(t) for k, t in templates.items()}
        text = {k: " ".join(w).encode() for k, w in self.words.items()}
        self.longest_word = max(len(w) for words in self.words.values() for w in words)
        # one set of parameters with and without a dictionary: only the dictionary makes a difference
        longest = 4 * PIECE * (self.longest_word + 1) + max(map(len, text.values()))
        level = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=8 * PIECE)
        params = zstandard.ZstdCompressionParameters(
            window_log=longest.bit_length(), write_content_size=False,
            **{k: getattr(level, k) for k in ("chain_log", "hash_log", "search_log", "min_match", "target_length", "strategy")})
        self.alone = zstandard.ZstdCompressor(compression_params=params)
        self.given = {k: zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(
            t, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for k, t in text.items()}
        self.tail = {k: re.search(r"\W*$", t)[0] for k, t in templates.items()}
        self.may_differ = {k: int(MAX_DIFFERENT * len(w)) for k, w in self.words.items()}
        #: Words a notice of each template can reach to either side of a trigger in it, the trigger's own included.
        self.reaches = {k: len(w) + self.may_differ[k] for k, w in self.words.items()}
        #: The same for any template (a trigger may cut a word).
        self.reach = 1 + max(self.reaches.values())
        self.naming = naming_words(templates)
        self.trigger = re.compile(TRIGGER)
        self.alone_size = lru_cache(BLOCKS_KEPT)(lambda data: len(self.alone.compress(data)))
        self.given_size = lru_cache(BLOCKS_KEPT)(lambda name, data: len(self.given[name].compress(data)))
        self.own_saving = {k: self.saved(k, w) for k, w in self.words.items()}

    def before(self, text: str, at: int, floor: int) -> int:
        """Start of the ``reach``-th word before ``at``, or ``floor``."""
        size = 16 * self.reach
        while True:
            lo = max(at - size, floor)
            starts = [m.start() for m in WORD.finditer(text, lo, at)]
            if len(starts) > self.reach:      # the first may be half a word
                return starts[-self.reach]
            if lo == floor:
                return floor
            size *= 2

    def after(self, text: str, at: int) -> int:
        """Start of the word behind the next ``reach`` words, or the text's end."""
        words = list(islice(WORD.finditer(text, at), self.reach + 1))
        return words[-1].start() if len(words) > self.reach else len(text)

    def passages(self, text: str) -> list[tuple[int, int, list[tuple[int, int]]]]:
        """(start, end, license words) of the words that a notice can reach
        from each license word, over any lines; those that meet are one."""
        out = []
        for at, end in (m.span() for m in self.trigger.finditer(text)):
            if out and out[-1][1] < at:
                out[-1][1] = self.after(text, out[-1][2][-1][1])
            if out and (out[-1][1] >= at or self.before(text, at, out[-1][1]) == out[-1][1]):
                out[-1][2].append((at, end))
            else:
                out.append([self.before(text, at, out[-1][1] if out else 0), end, [(at, end)]])
        if out:
            out[-1][1] = self.after(text, out[-1][2][-1][1])
        return out

    def saved(self, name: str, words: list[str]) -> int:
        """Bytes that a template as dictionary saves of some words, which are
        compressed in pieces of ``PIECE``.  A word longer than any of a
        template's is written as a mark: no dictionary saves any of it."""
        out = 0
        for lo in range(0, len(words), PIECE):
            data = " ".join([w if len(w) <= self.longest_word else "?" for w in words[lo:lo + PIECE]]).encode()
            out += self.alone_size(data) - self.given_size(name, data)
        return out

    def closest(self, words: list[str], name: str) -> tuple[int, int, list[str], list[str]]:
        """``align`` in stretches that overlap by the longest run that can be
        the closest (twice the template), so that memory stays bounded."""
        template, best = self.words[name], None
        for lo in range(0, max(len(words), 1), PIECE):
            first, end, missing, extra = align(words[lo:lo + PIECE + 2 * len(template)], template)
            if best is None or len(missing) + len(extra) < len(best[2]) + len(best[3]):
                best = lo + first, lo + end, missing, extra
        return best

    def ranked(self, savings: dict[str, int]) -> list[str]:
        """The templates by the bytes they save, most first."""
        return sorted(savings, key=lambda k: (-savings[k], k))

    def unconfirmed(self, block: str) -> tuple:
        """The row of a block without a notice: (None, top template, bytes it
        saves, None, the words missing from the closest passage, and extra)."""
        words = wording(block)
        savings = {k: self.saved(k, words) for k in self.words}
        top = self.ranked(savings)[0]
        return None, top, savings[top], None, *self.closest(words, top)[2:]

    def notice(self, own: list[str], at: int, floor: int) -> tuple | None:
        """(first, end, license, top template, its reduction, rank of the
        license, missing, extra) of the notice that holds word ``at`` and
        starts at ``floor`` or later: the best-ranked candidate whose wording
        is confirmed on words that hold it."""
        blocks = {k: (max(floor, at - reach + 1), at + reach) for k, reach in self.reaches.items()}
        savings = {k: self.saved(k, own[lo:hi]) for k, (lo, hi) in blocks.items()}
        ranked = self.ranked(savings)
        for rank, name in enumerate(ranked, 1):
            if savings[name] < LEAST_SAVED * self.own_saving[name]:
                continue
            lo, hi = blocks[name]
            first, end, missing, extra = align(own[lo:hi], self.words[name])
            if (lo + first <= at < lo + end and len(missing) + len(extra) <= self.may_differ[name]
                    and not self.naming & {*missing, *extra}):
                return lo + first, lo + end, name, ranked[0], savings[ranked[0]], rank, missing, extra
        return None

    def notices(self, block: str) -> list[tuple]:
        """(license, top template, its reduction, rank, missing, extra, start,
        end) of every notice in a block, in order: from license word to
        license word, those inside a notice passed over."""
        spans = [m.span() for m in WORD.finditer(block)]
        own = [block[lo:hi].lower() for lo, hi in spans]
        out, floor, w = [], 0, 0
        for hit in self.trigger.finditer(block):
            while w < len(spans) and spans[w][1] <= hit.start():
                w += 1
            if w < floor or w == len(spans):
                continue
            found = self.notice(own, w, floor)
            if found:
                first, floor, name, *row = found
                lo, hi = spans[first][0], spans[floor - 1][1]
                hi += len(self.tail[name]) * block.startswith(self.tail[name], hi)
                out.append((name, *row, lo, hi))
        return out

    def blocks(self, text: str):
        """(start, end, license, ...) of every notice, and of the lines with
        license words that are in none, up to the notices around them."""
        for at, end, hits in self.passages(text):
            hits, found = deque(hits), self.notices(text[at:end])
            for *row, lo, hi in [*((*row, at + lo, at + hi) for *row, lo, hi in found), (None, end, end)]:
                others = []
                while hits and hits[0][0] < lo:
                    others.append(hits.popleft())
                if others:
                    first = max(text.rfind("\n", at, others[0][0]) + 1, at)
                    last = text.find("\n", others[-1][1], lo)
                    last = lo if last < 0 else last
                    yield first, last, *self.unconfirmed(text[first:last])
                while hits and hits[0][0] < hi:
                    hits.popleft()
                if row[0]:
                    yield lo, hi, *row
                at = hi


def license_blocks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   templates: dict[str, str] | None = None) -> DataFrame:
    """One row per notice, and per run of lines with license words that are
    in none: the id, block (number in the text from 0), start, end (code points), license (confirmed template or null),
    top_template, reduction (bytes the top template saves), rank (of the
    confirmed one), missing, extra (differing words).

    Null, empty and trigger-free texts have no blocks.  Whole texts are
    scanned; a long text only costs its license lines.  Equal reductions
    rank by template name.  A notice is found by the license words in it; the
    templates are to hold one.  Repeated rows are scanned each.  An empty table
    gives an empty result; other columns are not looked at.
    """
    ship_by_value(__name__)
    templates = dict(templates or TEMPLATES)
    inp = df.where(F.col(text_col).rlike(TRIGGER)).select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    id_type = inp.schema["__id"].dataType.simpleString()

    def run(batches):
        scanner = Scanner(templates)
        words = pa.list_(pa.string())
        types = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), words, words]
        for b in batches:
            of, rows = [], []
            for r, t in enumerate(b.column(1)):
                t = t.as_py()
                found = list(scanner.blocks(t))
                of += [r] * len(found)
                rows += [(k, *row) for k, row in enumerate(found)]
            cols = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(of, pa.int64())),
                                              *(pa.array(c, t) for c, t in zip(cols, types))], names=names)

    names = [id_col, "block", "start", "end", "license", "top_template", "reduction", "rank", "missing", "extra"]
    return inp.mapInArrow(run, f"`{id_col}` {id_type}, block int, start int, end int, license string, top_template string, "
                               "reduction int, rank int, missing array<string>, extra array<string>")
