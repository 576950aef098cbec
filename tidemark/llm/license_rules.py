"""The signature rules of the license scan: ordered lists of hand-written patterns.

A rule has a keyword that must be in the text before its pattern is tried; it is what the pattern begins with, up to the
first character that is no letter, digit or space, unless one is given. Patterns are matched against words in lower case
with one space between them, so they are written with plain spaces and end at word ends.
"""

from __future__ import annotations

import re
from typing import NamedTuple

#: One of these is in every text that a rule matches. They are few, so that one look at a text is quick.
ANCHORS = (
    "licen", "lizenz", "copyright", "copyleft", "spdx", "rights reserved", "public domain", "permission", "warrant",
    "redistribut", "gpl", "cc0", "creative commons", "confidential", "trademark", "free software", "wtfpl", "trade secret",
    "use only", "open source", "commons clause", "own risk", "royalty free", "beerware", "patent", "as is", "waived",
    "terms of", "openrail", "fuck you", "not evil", "advertising materials", "jpeg group", "the mpl", "openssl project", "php software",
    "the cecill", "be liable", "x consortium", "misrepresented", "a beer", "netscape public", "apache software", "commercial purposes",
    "this document",
)


class Rule(NamedTuple):
    label: str
    keyword: str
    pattern: str
    #: Of overlapping detections the one of higher priority wins.
    priority: int
    confidence: float

    def gate(self) -> str:
        """What every text with a match has, in lower case; words may be apart by anything that separates words."""
        return next((a for a in ANCHORS if a in self.keyword or a in self.pattern), self.keyword)


# Names of licenses, by label. Of one label the more exact pattern comes first.
NAMES = """
0bsd | zero clause bsd licen[cs]e
afl | academic free licen[cs]e
agpl-3.0 | affero general public license (?:version |v ?)3(?: 0)?
agpl | affero general public license
aladdin | aladdin free public license
amazon | amazon software license
anti-996 | anti 996 license
apache-1.0 | apache (?:software )?license (?:version |v ?)?1 0
apache-1.1 | apache (?:software )?license (?:version |v ?)?1 1
apache-2.0 | apache (?:software )?license (?:version |v ?)?2(?: 0)?
apache | apache (?:software )?license
apsl | apple public source license
arphic | arphic public license
artistic-1.0 | artistic license (?:version |v ?)?1 0
artistic-2.0 | artistic license (?:version |v ?)?2 0
artistic | artistic license
beerware | beer ?ware license : beer
bigscience-rail | bigscience (?:bloom )?rail license
bitstream-vera | bitstream vera (?:fonts )?license
bittorrent | bittorrent open source license
blueoak | blue oak model license
boost | boost software license
bsd-1-clause | bsd 1 clause license
bsd-2-clause | (?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd) license : bsd
bsd-3-clause | (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd) license : bsd
bsd-3-clause-clear | clear bsd license
bsd-4-clause | (?:original bsd|bsd 4 clause|4 clause bsd) license : bsd
bsd-patent | bsd 2 clause plus patent license
bsd-protection | bsd protection license
bsd | bsd (?:style )?license
bsl | business source license
cal | cryptographic autonomy license
caldera | caldera license
catosl | computer associates trusted open source license
cc-by-nc-nd | cc by nc nd(?: [1-4] [05])? licen[cs]e
cc-by-nc-sa | cc by nc sa(?: [1-4] [05])?
cc-by-nc | cc by nc(?: [1-4] [05])? licen[cs]e
cc-by-nd | cc by nd(?: [1-4] [05])? licen[cs]e
cc-by-sa | cc by sa(?: [1-4] [05])? licen[cs]e
cc-by-4.0 | cc by 4 0 licen[cs]e
cc-by-nc-nd | creative commons attribution non ?commercial no ?deriv(?:ative|ativ)e?s
cc-by-nc-sa | creative commons attribution non ?commercial share ?alike
cc-by-nc | creative commons attribution non ?commercial
cc-by-nd | creative commons attribution no ?deriv(?:ative|ativ)e?s
cc-by-sa | creative commons attribution share ?alike
cc-by | creative commons attribution
cc0 | cc0(?: 1 0)?(?: universal)?
cc0 | creative commons zero(?: 1 0)?(?: universal)?
creative-commons | creative commons license
cddl | common development and distribution license
cdla-permissive | community data license agreement permissive
cdla-sharing | community data license agreement sharing
cecill | cecill(?: [abc])? (?:free software )?license
cern-ohl-p | cern open hardware licen[cs]e (?:version |v ?)?2 permissive
cern-ohl-s | cern open hardware licen[cs]e (?:version |v ?)?2 strongly reciprocal
cern-ohl-w | cern open hardware licen[cs]e (?:version |v ?)?2 weakly reciprocal
cern-ohl | cern open hardware licen[cs]e
cnri-python | cnri python license
commons-clause | commons clause license condition
condor | condor public license
cpal | common public attribution license
cpl | common public license
cpol | code project open license
creativeml-openrail | creativeml open ?rail ?m license
cua-opl | cua office public license
d-fsl | deutsche freie software lizenz
drl | detection rule license
ecl | educational community license
efl | eiffel forum license
elastic | elastic license
entessa | entessa public license
epl-1.0 | eclipse public license (?:version |v ?)?1 0
epl-2.0 | eclipse public license (?:version |v ?)?2 0
epl | eclipse public license
erlang | erlang public license
etalab | (?:etalab open|licence ouverte) licen[cs]e : licen
eudatagrid | eu datagrid software license
eupl | european union public licen[cs]e
eurosym | eurosym license
fair | fair license
frameworx | frameworx open license
freetype | freetype (?:project )?license
functional-source | functional source license
gfdl | free documentation license
giftware | giftware license
glide | glide source code general public license
gpl-1.0 | general public license (?:version |v ?)1(?: 0)?
gpl-2.0 | general public license (?:version |v ?)2(?: 0)?
gpl-3.0 | general public license (?:version |v ?)3(?: 0)?
gust | gust font license
hippocratic | hippocratic license
hpnd | historical permission notice and disclaimer
ibm | ibm public license
icu | icu license
ijg | independent jpeg group license
imagemagick | imagemagick license
info-zip | info zip license
intel | intel open source license
interbase | interbase public license
ipa | ipa font license
isc | isc license
jasper | jasper license
json | json license
latex | latex project public license
leptonica | leptonica license
lgpl-2.0 | library general public license (?:version |v ?)2(?: 0)?
lgpl-2.1 | lesser general public license (?:version |v ?)2(?: 1)?
lgpl-3.0 | lesser general public license (?:version |v ?)3(?: 0)?
lgpl | (?:lesser|library) general public license : general public license
libpng | libpng license
libtiff | libtiff license
liliq | licence libre du quebec
llama | llama [234] community license
lucent | lucent public license
mirros | mirros licen[cs]e
mit-0 | mit no attribution licen[cs]e
mit | (?:mit|expat|x11) licen[cs]e : licen
motosoto | motosoto open source license
mpl-1.0 | mozilla public license (?:version |v ?)?1 0
mpl-1.1 | mozilla public license (?:version |v ?)?1 1
mpl-2.0 | mozilla public license (?:version |v ?)?2(?: 0)?
mpl | mozilla public license
ms-lpl | microsoft limited public license
ms-pl | microsoft public license
ms-rl | microsoft (?:limited )?reciprocal license
mulan | mulan permissive software license
multics | multics license
nasa | nasa open source agreement
naumen | naumen public license
ncsa | ncsa open source license
nethack | nethack general public license
netscape | netscape public license
nokia | nokia open source license
nposl | non profit open software license
ntp | ntp license
nvidia | nvidia open model license
oclc | oclc research public license
odbl | open database license
odc-by | open data commons attribution license
ofl | open font license
ogl | open government licen[cs]e
ogtsl | open group test suite license
opencontent | open content license
openldap | openldap public license
openrail | openrail m? ?license
openssl | openssl license
oset | oset public license
osl | open software license
parity | parity public license
pddl | public domain dedication and license
php | php license
polyform-free-trial | polyform free trial license
polyform-internal | polyform internal use license
polyform-noncommercial | polyform noncommercial license
polyform-perimeter | polyform perimeter license
polyform-shield | polyform shield license
polyform-small-business | polyform small business license
polyform-strict | polyform strict license
postgresql | postgresql licen[cs]e
psf | python software foundation license
publication | open publication license
python | python license
qpl | q public license
rpl | reciprocal public license
rpsl | realnetworks public source license
ricoh | ricoh source code public license
ruby | ruby license
sgi-b | sgi free software license b
simpl | simple public license
sissl | sun industry standards source license
sleepycat | sleepycat license
spl | sun public license
sspl | server side public license
sugarcrm | sugarcrm public license
tapr | tapr open hardware license
tcl | tcl tk license
tmate | tmate open source license
ubuntu-font | ubuntu font licen[cs]e
unicode | unicode license
unlicense | unlicense
upl | universal permissive license
vim | vim license
vovida | vovida software license
w3c | w3c software (?:notice and )?license
watcom | open watcom public license
wtfpl | wtfpl
wtfpl | do what the fuck you want to public license
xnet | x net license
yahoo | yahoo public license
zed | zed license
zend | zend license
zimbra | zimbra public license
zlib | zlib(?: libpng)? license
zpl | zope public license
"""

# Sentences of license texts, headers and notices that name the license by their wording.
BODIES = """
apache-1.1 | this product includes software developed by the apache software foundation : software developed by : licen
apache-2.0 | you may not use this file except in compliance with the license
apache-2.0 | unless required by applicable law or agreed to in writing software distributed under the license
artistic | the intent of this document is to state the conditions under which a package may be copied : intent of this document
beerware | you can buy me a beer in return
boost | permission is hereby granted free of charge to any person or organization obtaining a copy
bsd | redistribution and use in source and binary forms
bsd-3-clause | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause | all advertising materials mentioning features or use of this software must display
cc-by-nc | you may not use the material for commercial purposes
cc0 | has waived all copyright and related or neighboring rights
cecill | this software is governed by the cecill
curl | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided
epl | the accompanying program and the accompanying materials are made available under the terms of
gfdl | permission is granted to copy distribute and or modify this document
gpl | this program is free software you can redistribute it and or modify
gpl | everyone is permitted to copy and distribute verbatim copies of this license document
gpl | this program comes with absolutely no warranty
gpl | as published by the free software foundation
gpl-or-later | of the license or at your option any later version
hpnd | permission to use copy modify distribute and sell this software and its documentation
ijg | this software is based in part on the work of the independent jpeg group : independent jpeg group
isc | permission to use copy modify and or distribute this software for any purpose
json | the software shall be used for good not evil
lgpl | this library is free software you can redistribute it and or modify
linking-exception | as a special exception the copyright holders give you permission to link
mit | permission is hereby granted free of charge to any person obtaining a copy
mit | the above copyright notice and this permission notice shall be included in all copies
mpl-2.0 | this source code form is subject to the terms of the mozilla public
mpl-2.0 | if a copy of the mpl was not distributed with this file
ms-pl | if you use the software you accept this license
ncsa | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal with
netscape | the contents of this file are subject to the netscape public
ofl | this font software is licensed under
openssl | this product includes software developed by the openssl project
php | this product includes php software freely available from
postgresql | in no event shall the university of california be liable to any party
psf | psf is making python available to licensee on an as is basis
ruby | you may redistribute it and or modify it under either the terms of
sleepycat | redistributions in any form must be accompanied by information on how to obtain complete source code
unlicense | this is free and unencumbered software released into the public domain
vim | it is allowed to redistribute the software without restrictions if you
w3c | this work is being provided by the copyright holders under the following license
wtfpl | you just do what the fuck you want to
x11 | except as contained in this notice the name of the x consortium shall not be used
zlib | this software is provided as is without any express or implied warranty
zlib | altered source versions must be plainly marked as such and must not be misrepresented
"""

# Identifiers of the SPDX list, as words, by label.
IDENTIFIERS = """
0bsd | 0bsd
afl | afl 3 0
agpl-3.0 | agpl 3 0(?: only| or later)?
apache-2.0 | apache 2 0
artistic-2.0 | artistic 2 0
blueoak | blueoak 1 0 0
boost | bsl 1 0
bsd-2-clause | bsd 2 clause
bsd-3-clause | bsd 3 clause
bsd-4-clause | bsd 4 clause
bsl | busl 1 1
cc-by-4.0 | cc by 4 0
cc-by-nc-4.0 | cc by nc 4 0
cc-by-nc-sa-4.0 | cc by nc sa 4 0
cc-by-nd-4.0 | cc by nd 4 0
cc-by-sa-4.0 | cc by sa 4 0
cc0 | cc0 1 0
cddl | cddl 1 [01]
cecill | cecill 2 1
ecl | ecl 2 0
elastic | elastic 2 0
epl-1.0 | epl 1 0
epl-2.0 | epl 2 0
eupl | eupl 1 [12]
gfdl | gfdl 1 [1-3](?: only| or later)?
gpl-2.0 | gpl 2 0(?: only| or later)?
gpl-3.0 | gpl 3 0(?: only| or later)?
hpnd | hpnd
isc | isc
lgpl-2.1 | lgpl 2 1(?: only| or later)?
lgpl-3.0 | lgpl 3 0(?: only| or later)?
mit-0 | mit 0
mit | mit
mpl-2.0 | mpl 2 0
ms-pl | ms pl
mulan | mulanpsl 2 0
ncsa | ncsa
odbl | odbl 1 0
ofl | ofl 1 1
osl | osl 3 0
postgresql | postgresql
psf | psf 2 0
sspl | sspl 1 0
unlicense | unlicense
upl | upl 1 0
wtfpl | wtfpl
zlib | zlib
zpl | zpl 2 1
"""

# What a text says about rights without naming a license.
NOTICES = """
as-is | provided (?:strictly )?as is : provided
attribution-required | attribution (?:is )?required under this license
commercial | commercial license
confidential | (?:strictly|company) confidential : confidential
copyleft | copyleft
copyright | copyright
crown-copyright | crown copyright
dual-licensed | dual licensed
educational | (?:for )?educational use only : educational use only
eula | end user license agreement
evaluation | evaluation use only
free-software | free software
gpl | gpl(?: ?v ?[123])?
lgpl | lgpl(?: ?v ?[23])?
agpl | agpl(?: ?v ?3)?
internal | internal use only
license-file | see the license file
license-granted | license is hereby granted
license-key | license key
licensed-material | licensed material
no-derivatives | no derivatives license
no-redistribution | (?:not for redistribution|redistribution is prohibited|do not redistribute) : redistribut
no-rights | no rights reserved
no-warranty | without warranty of any kind
no-warranty | without even the implied warranty of
non-commercial | non commercial use only
open-source | open source software
own-risk | (?:use )?at your own risk : own risk
patent | patent pending
permission-denied | may not be reproduced without (?:prior )?(?:written )?permission
personal | personal use only
proprietary | (?:proprietary and confidential|confidential and proprietary) : confidential
public-domain | public domain
public-domain-mark | public domain mark
reprinted | reprinted with permission
reproduced | reproduced with permission
research | research use only
reserved | (?:all|some) rights reserved : rights reserved
royalty-free | royalty free license
source-available | source available license
spdx | spdx license identifier
terms-of-service | terms of service
trade-secret | trade secrets?
trademark | trademarks? of their respective owners
trademark | registered trademark
used-with-permission | used with permission
warranty-disclaimer | disclaims all warranties
"""

_PLAIN = re.compile("[a-z0-9 ]*")
# Priority and confidence of each list. A label with a version goes before the one without.
NAME, BODY, IDENTIFIER, NOTICE = (30, 0.7), (60, 0.9), (70, 1.0), (20, 0.5)


def _rules(table: str, priority: int, confidence: float, before: str = "") -> list[Rule]:
    made = []
    for line in table.strip().splitlines():
        label, _, rest = line.partition(" | ")
        pattern, _, keyword = rest.partition(" : ")
        pattern = before + pattern
        keyword = keyword.partition(" : ")[0] or _PLAIN.match(pattern)[0].rstrip()
        if pattern[len(keyword) : len(keyword) + 1] in "?":
            keyword = keyword if pattern == keyword else keyword[:-1].rstrip()
        made.append(Rule(label, keyword, pattern, priority + any(c.isdigit() for c in label), confidence))
    return made


# The base phrases of the contract.
BASE_RULES: tuple[Rule, ...] = (
    Rule("cc-by", "cc by", "cc by", 0, 0.5),
    Rule("gpl", "general public license", "general public license", 0, 0.5),
    Rule("reserved", "all rights reserved", "all rights reserved", 0, 0.5),
)


def rules() -> list[Rule]:
    """All rules but the base ones."""
    return [
        *_rules(NAMES, *NAME),
        *_rules(BODIES, *BODY),
        *_rules(IDENTIFIERS, *IDENTIFIER, "spdx license identifier "),
        *_rules(NOTICES, *NOTICE),
    ]
