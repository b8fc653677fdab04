"""License scans by ordered signature rules.

Texts are taken as lower-case words joined by one space. A rule has a label, a priority, a keyword and a pattern over
that form; its pattern runs only on texts that contain its keyword. Detections are settled in order of priority, then
length, then place: one whose interval lies inside that of a settled detection is suppressed. Rules of priority 0 are
the base phrases; they are always reported and suppress nothing that is not inside them.

Rows: null and empty texts have no words, no labels and score 0. Repeated rows are scanned as they come. Words are
counted on whole texts, very long ones too; labels are distinct and sorted. An empty table gives an empty result. Columns other than id
and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .common import read

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: label ; priority (smaller is stronger) ; keyword ; pattern. V stands for a version, written as words.
RULES = r"""
apache-2.0 ; 1 ; apache ; licensed under the apache license version 2( 0)?
apache-2.0 ; 2 ; apache ; apache license version 2 0 january 2004
apache-2.0 ; 3 ; apache ; apache (software )?licen[sc]e (version |v)?2( 0)?
apache-2.0 ; 3 ; apache ; www apache org licenses license 2 0
apache-1.1 ; 3 ; apache ; apache (software )?licen[sc]e (version |v)?1 1
apache-1.0 ; 3 ; apache ; apache (software )?licen[sc]e (version |v)?1 0
apache ; 6 ; apache ; (under|the) (the )?apache (software )?licen[sc]e
mit ; 1 ; permission ; permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit ; 2 ; merchantability ; the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit ; 3 ; mit ; (released|licensed|distributed|available|published) under the (terms of the )?mit licen[sc]e
mit ; 3 ; opensource ; opensource org licenses mit( license)?( php)?
mit ; 5 ; mit ; (the )?mit licen[sc]e
expat ; 4 ; expat ; expat licen[sc]e
x11 ; 4 ; x11 ; x11 licen[sc]e
mit-0 ; 3 ; mit ; mit no attribution
isc ; 2 ; permission ; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc ; 4 ; isc ; (the )?isc licen[sc]e
0bsd ; 3 ; bsd ; (zero clause bsd|bsd zero clause|0bsd)( licen[sc]e)?
bsd-2-clause ; 2 ; bsd ; (2|two) clause bsd( licen[sc]e)?
bsd-3-clause ; 2 ; bsd ; (3|three) clause bsd( licen[sc]e)?
bsd-4-clause ; 2 ; bsd ; (4|four) clause bsd( licen[sc]e)?
bsd-2-clause ; 2 ; bsd ; bsd 2 clause( licen[sc]e)?
bsd-3-clause ; 2 ; bsd ; bsd 3 clause( licen[sc]e)?
bsd-4-clause ; 2 ; bsd ; bsd 4 clause( licen[sc]e)?
bsd-simplified ; 3 ; bsd ; simplified bsd licen[sc]e
bsd-new ; 3 ; bsd ; (new|revised|modified) bsd licen[sc]e
bsd-original ; 3 ; bsd ; original bsd licen[sc]e
bsd ; 2 ; redistribution ; redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause ; 1 ; endorse ; neither the name of .{1,80} nor the names of its contributors may be used to endorse or promote products
bsd-4-clause ; 1 ; advertising ; all advertising materials mentioning features or use of this software must display
bsd ; 6 ; bsd ; (the )?bsd( style)? licen[sc]e
gpl-2.0-or-later ; 1 ; general ; gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3.0-or-later ; 1 ; general ; gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2.0-only ; 2 ; general ; gnu general public license as published by the free software foundation version 2
gpl-3.0-only ; 2 ; general ; gnu general public license as published by the free software foundation version 3
gpl-any ; 5 ; general ; gnu general public license
gpl-any ; 6 ; gpl ; (under|the) (the )?(gnu )?gpl
gpl-classpath ; 3 ; classpath ; classpath exception
gpl-linking ; 3 ; linking ; (gcc|openssl|font|autoconf|bison)? ?linking exception
gpl-font ; 3 ; font ; font embedding exception
lgpl-any ; 4 ; lesser ; gnu lesser general public license
lgpl-any ; 4 ; library ; gnu library general public license
lgpl-any ; 6 ; lgpl ; (under|the) (the )?(gnu )?lgpl
agpl-any ; 4 ; affero ; gnu affero general public license
agpl-any ; 6 ; agpl ; (under|the) (the )?(gnu )?agpl
fdl-any ; 4 ; documentation ; gnu free documentation license
fdl-any ; 6 ; gfdl ; gfdl
cc0-1.0 ; 2 ; cc0 ; cc0( 1 0)?( universal)?
cc0-1.0 ; 2 ; publicdomain ; creativecommons org publicdomain zero 1 0
cc-pdm ; 3 ; publicdomain ; creativecommons org publicdomain mark 1 0
cc-pdm ; 3 ; domain ; public domain mark
public-domain ; 5 ; domain ; (is |are |dedicated to |released (in)?to |placed in |in )the public domain
unlicense ; 2 ; unencumbered ; this is free and unencumbered software released into the public domain
unlicense ; 4 ; unlicense ; (the )?unlicense
wtfpl ; 3 ; wtfpl ; wtfpl
creative-commons ; 7 ; commons ; creative commons( licen[sc]e)?
mpl-1.0 ; 3 ; mozilla ; mozilla public licen[sc]e (version |v)?1 0
mpl-1.1 ; 3 ; mozilla ; mozilla public licen[sc]e (version |v)?1 1
mpl-2.0 ; 3 ; mozilla ; mozilla public licen[sc]e (version |v)?2( 0)?
mpl-2.0 ; 2 ; mozilla ; subject to the terms of the mozilla public licen[sc]e v 2 0
mpl-any ; 6 ; mozilla ; mozilla public licen[sc]e
epl-1.0 ; 3 ; eclipse ; eclipse public licen[sc]e (version |v)?1 0
epl-2.0 ; 3 ; eclipse ; eclipse public licen[sc]e (version |v)?2( 0)?
epl-any ; 6 ; eclipse ; eclipse public licen[sc]e
edl-1.0 ; 3 ; eclipse ; eclipse distribution licen[sc]e
cddl-1.0 ; 3 ; cddl ; cddl (version |v)?1 0
cddl-1.1 ; 3 ; cddl ; cddl (version |v)?1 1
cddl-any ; 5 ; distribution ; common development and distribution licen[sc]e
cpl-1.0 ; 3 ; common ; common public licen[sc]e
cpal-1.0 ; 3 ; attribution ; common public attribution licen[sc]e
ipl-1.0 ; 3 ; ibm ; ibm public licen[sc]e
eupl-1.1 ; 3 ; european ; european union public licen[sc]e (version |v)?1 1
eupl-1.2 ; 3 ; european ; european union public licen[sc]e (version |v)?1 2
eupl-any ; 6 ; european ; european union public licen[sc]e
eupl-any ; 6 ; eupl ; eupl
cecill-2.1 ; 3 ; cecill ; cecill (version |v)?2 1
cecill-b ; 3 ; cecill ; cecill b
cecill-c ; 3 ; cecill ; cecill c
cecill-any ; 6 ; cecill ; cecill
artistic-1.0 ; 3 ; artistic ; artistic licen[sc]e (version |v)?1 0
artistic-2.0 ; 3 ; artistic ; artistic licen[sc]e (version |v)?2( 0)?
artistic-any ; 6 ; artistic ; (the )?artistic licen[sc]e
perl ; 3 ; perl ; under the same terms as perl( itself)?
psf-2.0 ; 3 ; python ; python software foundation licen[sc]e( version 2)?
python-2.0 ; 3 ; python ; python licen[sc]e (version |v)?2 0
ruby ; 3 ; ruby ; (the )?ruby licen[sc]e
php-3.01 ; 3 ; php ; php licen[sc]e (version |v)?3 01
php-any ; 5 ; php ; (the )?php licen[sc]e
zlib ; 2 ; misrepresented ; the origin of this software must not be misrepresented
zlib ; 4 ; zlib ; (the )?zlib( libpng)? licen[sc]e
libpng ; 4 ; libpng ; libpng licen[sc]e
boost-1.0 ; 2 ; boost ; boost software licen[sc]e( version 1 0)?
openssl ; 4 ; openssl ; openssl( project)? licen[sc]e
curl ; 4 ; curl ; curl licen[sc]e
ncsa ; 4 ; illinois ; university of illinois( ncsa)? open source licen[sc]e
w3c ; 4 ; w3c ; w3c (software (notice and )?|document )licen[sc]e
unicode ; 4 ; unicode ; unicode( inc)? licen[sc]e agreement
icu ; 4 ; icu ; icu licen[sc]e
postgresql ; 4 ; postgresql ; postgresql licen[sc]e
afl-3.0 ; 4 ; academic ; academic free licen[sc]e( version 3 0)?
osl-3.0 ; 4 ; open ; open software licen[sc]e (version |v)?3 0
ofl-1.1 ; 3 ; sil ; sil open font licen[sc]e( version 1 1)?
odbl-1.0 ; 3 ; database ; open database licen[sc]e
odc-by-1.0 ; 3 ; commons ; open data commons attribution licen[sc]e
pddl-1.0 ; 3 ; dedication ; public domain dedication and licen[sc]e
ogl-3.0 ; 3 ; government ; open government licen[sc]e( v3 0| version 3 0)?
etalab-2.0 ; 3 ; ouverte ; licence ouverte( 2 0)?
dl-de-by-2.0 ; 3 ; datenlizenz ; datenlizenz deutschland namensnennung( version)? 2 0
dl-de-zero-2.0 ; 3 ; datenlizenz ; datenlizenz deutschland zero( version)? 2 0
ms-pl ; 3 ; microsoft ; microsoft public licen[sc]e
ms-rl ; 3 ; microsoft ; microsoft reciprocal licen[sc]e
apsl-2.0 ; 3 ; apple ; apple public source licen[sc]e
qpl-1.0 ; 3 ; public ; q public licen[sc]e
sleepycat ; 3 ; sleepycat ; sleepycat licen[sc]e
upl-1.0 ; 3 ; permissive ; universal permissive licen[sc]e
vim ; 4 ; vim ; vim licen[sc]e
mulan-2.0 ; 3 ; mulan ; mulan (psl|permissive software licen[sc]e)
bsl-1.1 ; 3 ; business ; business source licen[sc]e( 1 1)?
sspl-1.0 ; 3 ; server ; server side public licen[sc]e
elastic-2.0 ; 3 ; elastic ; elastic licen[sc]e( 2 0)?
commons-clause ; 3 ; clause ; commons clause
polyform ; 3 ; polyform ; polyform (noncommercial|small business|shield|strict|free trial) licen[sc]e
openrail ; 3 ; openrail ; (creativeml |bigcode )?openrail( m)?( licen[sc]e)?
llama ; 3 ; llama ; llama( 2| 3)? community licen[sc]e
json ; 3 ; evil ; the software shall be used for good not evil
beerware ; 3 ; beer ; beer ?ware licen[sc]e
proprietary ; 4 ; proprietary ; proprietary and confidential
proprietary ; 4 ; confidential ; confidential and proprietary
proprietary ; 5 ; trade ; trade secrets? (of|and)
proprietary ; 5 ; unauthorized ; unauthorized (copying|reproduction|distribution|use) (of|or) .{1,60}(is )?(strictly )?prohibited
proprietary ; 5 ; permission ; without (the )?(prior |express )*(written )?permission (of|from)
eula ; 5 ; eula ; end user licen[sc]e agreement( eula)?
eula ; 5 ; end ; end user licen[sc]e agreement
copyright ; 7 ; copyright ; copyright( c)?( by)? (19|20)\d\d
copyright ; 7 ; copyrighted ; copyrighted (material|work|by)
no-ai ; 4 ; train ; (may not|must not|not) be used (for|to) (the )?(training|train)( of)?
non-commercial ; 6 ; commercial ; (for )?non ?commercial (use|purposes?)( only)?
academic-use ; 6 ; only ; for (academic|research)( and (academic|research|educational))? (use|purposes) only
with-permission ; 6 ; permission ; (used|reprinted|reproduced) (with|by) (kind )?permission
licensed ; 8 ; licensed ; (this )?(work|software|content|document|file|program|material) is licensed under
"""

#: Families written by version: label prefix, keyword, names, versions.
GNU = (("gpl", "general", r"(gnu )?general public licen[sc]e", ("1", "2", "3")), ("lgpl", "lesser", r"(gnu )?lesser general public licen[sc]e", ("2 1", "3")), ("lgpl", "library", r"(gnu )?library general public licen[sc]e", ("2",)), ("agpl", "affero", r"(gnu )?affero general public licen[sc]e", ("1", "3")), ("fdl", "documentation", r"(gnu )?free documentation licen[sc]e", ("1 1", "1 2", "1 3")), ("gpl", "gpl", r"(gnu )?gpl", ("1", "2", "3")), ("lgpl", "lgpl", r"(gnu )?lgpl", ("2", "2 1", "3")), ("agpl", "agpl", r"(gnu )?agpl", ("1", "3")))
CC = {"by": "attribution", "by sa": "attribution share ?alike", "by nc": "attribution non ?commercial", "by nd": "attribution no ?deriv(ative)?s", "by nc sa": "attribution non ?commercial share ?alike", "by nc nd": "attribution non ?commercial no ?deriv(ative)?s"}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")


@lru_cache(maxsize=1)
def rules() -> list[tuple[int, str, str, re.Pattern]]:
    """(priority, label, keyword, pattern), the hand-written rules and the families, in order."""
    out = [(0, label, max(phrase.split(), key=len), phrase) for phrase, label in BASE.items()]
    for line in RULES.strip().splitlines():
        label, priority, keyword, pattern = (x.strip() for x in line.split(" ; "))
        out.append((int(priority), label, keyword, pattern))
    for label, keyword, name, versions in GNU:
        for v in versions:
            short = f"{label}-{v.replace(' ', '.')}" + (".0" if " " not in v else "")
            out.append((2, short + "-or-later", keyword, rf"{name} (version |v)?{v}( 0)? or (\(?at your option\)? )?(any )?later( version)?"))
            out.append((3, short, keyword, rf"{name} (version |v )?v?{v}( 0)?"))
            out.append((3, short + "-only", keyword, rf"{name} (version |v)?{v}( 0)? only"))
    for code, words in CC.items():
        for v in CC_VERSIONS:
            label = f"cc-{code}-{v}".replace(" ", "-", code.count(" ")).replace(" ", ".")
            out.append((2, label, "cc", rf"cc {code} {v}"))
            out.append((2, label, "commons", rf"creative commons {words} {v}( international| unported| generic)?"))
            out.append((2, label, "creativecommons", rf"creativecommons org licenses {code} {v}"))
        if code != "by":
            out.append((4, "cc-" + code.replace(" ", "-"), "cc", rf"cc {code}"))
        out.append((4, "cc-" + code.replace(" ", "-"), "commons", rf"creative commons {words}( licen[sc]e)?"))
    out += [(1, "spdx-" + x, "spdx", rf"spdx licen[sc]e identifier {x.replace('-', ' ').replace('.', ' ')}") for x in "mit isc apache-2.0 bsd-2-clause bsd-3-clause gpl-2.0 gpl-3.0 lgpl-2.1 lgpl-3.0 agpl-3.0 mpl-2.0 epl-2.0 cc0-1.0 unlicense bsl-1.0 zlib".split()]
    out = [(p, label, k, re.compile(rf"(?<![^ ])(?:{x})(?![^ ])")) for p, label, k, x in out]
    return sorted(out, key=lambda r: r[0])


_TO_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


class Cover:
    """Settled intervals; whether one of them holds another is found in logarithmic time, by the furthest end of all that
    start no later. ``starts`` lists every start that may come."""

    def __init__(self, starts: list[int]):
        self.starts = sorted(set(starts))
        self.far = [-1] * (len(self.starts) + 1)

    def add(self, start: int, end: int) -> None:
        i = bisect_right(self.starts, start)
        while i < len(self.far):
            self.far[i] = max(self.far[i], end)
            i += i & -i

    def holds(self, start: int, end: int) -> bool:
        i, far = bisect_right(self.starts, start), -1
        while i:
            far = max(far, self.far[i])
            i -= i & -i
        return far >= end


def scan(text: str | None) -> dict:
    """Words, base places and settled detections (start and end word, label, priority) of one text."""
    raw = (text or "").encode("utf-8", "replace").lower()  # bytes: only A-Z change
    words = raw.translate(_TO_WORDS).split()
    found: list[tuple[int, int, int, str]] = []
    base: list[tuple[int, str]] = []
    active = [r for r in rules() if r[2].encode() in raw]
    if active:
        joined = b" ".join(words).decode("utf-8", "replace")
        for priority, label, _, pattern in active:
            for m in pattern.finditer(joined):
                found.append((priority, m.start(), m.end(), label))
        found.sort(key=lambda d: (d[0], d[1] - d[2], d[1], d[3]))
        settled: list[tuple[int, int, int, str]] = []
        strong = Cover([d[1] for d in found])
        gaps = [m.start() for m in re.finditer(" ", joined)] if found else []
        for d in found:
            if d[0] == 0:
                base.append((bisect_left(gaps, d[1]), d[3]))
                settled.append(d)
            elif not strong.holds(d[1], d[2]):
                strong.add(d[1], d[2])
                settled.append(d)
        found = [(p, bisect_left(gaps, s), bisect_left(gaps, e - 1), label) for p, s, e, label in settled]
    doubt = 1.0
    for p, *_ in found:
        doubt *= 1 - 0.95 * 0.8 ** max(p - 1, 0)
    starts = [s for s, _ in base]
    return {
        "n_words": len(words), "n_base": len(base), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted({x for _, x in base})), "labels": ",".join(sorted({d[3] for d in found})), "score": 1 - doubt,
        "spans": [{"start": s, "end": e, "label": label, "priority": p} for p, s, e, label in sorted(found, key=lambda d: (d[1], d[0], d[2], d[3]))],
    }


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<start:long,end:long,label:string,priority:long>>"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and what ``scan`` finds, one row per document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = pd.DataFrame([scan(t) for t in b["_text"]], index=b.index)
            for c in ("first_word", "last_word"):
                if c in out:
                    out[c] = out[c].astype("Int64")
            if len(b):
                out.insert(0, id_col, b["_id"])
                yield out

    rows = docs.selectExpr(f"`{id_col}` as _id", f"cast(`{text_col}` as string) as _text")
    return rows.mapInPandas(run, f"`{id_col}` {kind}, {COLUMNS}")


def op6_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan_licenses(read(spark, sf, "documents")).drop("spans")
