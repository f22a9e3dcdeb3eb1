"""Signatures of licences, over words joined by single spaces. Fixed values."""

from __future__ import annotations

# label | keyword that any match contains | the licence's name
NAMES = r"""
mit | mit | mit licen[cs]e|mit x11|expat licen[cs]e(?= mit)
mit-0 | mit | mit no attribution|mit 0
x11 | x11 | x11 licen[cs]e
expat | expat | expat licen[cs]e
apache-1.0 | apache | apache(?: software)? licen[cs]e(?: version)? 1 0
apache-1.1 | apache | apache(?: software)? licen[cs]e(?: version)? 1 1
apache-2.0 | apache | apache(?: software)? licen[cs]e(?: version| v)? ?2(?: 0)?|apache 2 0
apache | apache | apache(?: software)? licen[cs]e
gpl-1.0 | general | (?:gnu )?general public licen[cs]e(?: gpl)?(?: version| v)? ?1(?: 0)?
gpl-2.0 | general | (?:gnu )?general public licen[cs]e(?: gpl)?(?: version| v)? ?2(?: 0)?
gpl-2.0-or-later | general | (?:gnu )?general public licen[cs]e(?: gpl)?(?: version| v)? ?2(?: 0)? or (?:at your option )?(?:any )?later
gpl-3.0 | general | (?:gnu )?general public licen[cs]e(?: gpl)?(?: version| v)? ?3(?: 0)?
gpl-3.0-or-later | general | (?:gnu )?general public licen[cs]e(?: gpl)?(?: version| v)? ?3(?: 0)? or (?:at your option )?(?:any )?later
gpl | general | (?:gnu )?general public licen[cs]e
gpl-2.0 | gpl | gpl ?(?:version |v)?2(?: 0)?
gpl-3.0 | gpl | gpl ?(?:version |v)?3(?: 0)?
lgpl-2.0 | library | (?:gnu )?library general public licen[cs]e(?:(?: version| v)? ?2(?: 0)?)?
lgpl-2.1 | lesser | (?:gnu )?lesser general public licen[cs]e(?: lgpl)?(?: version| v)? ?2 1
lgpl-3.0 | lesser | (?:gnu )?lesser general public licen[cs]e(?: lgpl)?(?: version| v)? ?3(?: 0)?
lgpl | lesser | (?:gnu )?lesser general public licen[cs]e
lgpl-2.1 | lgpl | lgpl ?(?:version |v)?2 1
lgpl-3.0 | lgpl | lgpl ?(?:version |v)?3(?: 0)?
agpl-3.0 | affero | (?:gnu )?affero general public licen[cs]e(?:(?: version| v)? ?3(?: 0)?)?
agpl-3.0 | agpl | agpl ?(?:version |v)?3(?: 0)?
gfdl-1.2 | documentation | (?:gnu )?free documentation licen[cs]e(?: version)? 1 2
gfdl-1.3 | documentation | (?:gnu )?free documentation licen[cs]e(?: version)? 1 3
gfdl | documentation | (?:gnu )?free documentation licen[cs]e
bsd-2-clause | bsd | (?:2 clause|simplified|two clause) bsd|bsd 2 clause
bsd-3-clause | bsd | (?:3 clause|new|revised|modified|three clause) bsd|bsd 3 clause
bsd-4-clause | bsd | (?:4 clause|original|four clause) bsd|bsd 4 clause
0bsd | bsd | zero clause bsd|0 ?bsd
bsd | bsd | bsd(?: style)? licen[cs]e
isc | isc | isc licen[cs]e
mpl-1.0 | mozilla | mozilla public licen[cs]e(?: version| v)? ?1 0
mpl-1.1 | mozilla | mozilla public licen[cs]e(?: version| v)? ?1 1
mpl-2.0 | mozilla | mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?
mpl-2.0 | mpl | mpl ?(?:v|version )?2(?: 0)?
mpl | mozilla | mozilla public licen[cs]e
epl-1.0 | eclipse | eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?
epl-2.0 | eclipse | eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?
epl | eclipse | eclipse public licen[cs]e
cddl-1.0 | distribution | common development and distribution licen[cs]e(?: version)?(?: 1 0)?
cddl-1.1 | distribution | common development and distribution licen[cs]e(?: version)? 1 1
cpl-1.0 | common | common public licen[cs]e(?:(?: version)? 1 0)?
ipl-1.0 | ibm | ibm public licen[cs]e
eupl-1.1 | union | european union public licen[cs]e(?: version| v)? ?1 1
eupl-1.2 | union | european union public licen[cs]e(?: version| v)? ?1 2
eupl | eupl | eupl(?: v?1 [012])?
artistic-1.0 | artistic | artistic licen[cs]e(?: version)? 1(?: 0)?
artistic-2.0 | artistic | artistic licen[cs]e(?: version)? 2(?: 0)?
artistic | artistic | artistic licen[cs]e
zlib | zlib | zlib(?: libpng)? licen[cs]e
libpng | libpng | libpng licen[cs]e
bsl-1.0 | boost | boost software licen[cs]e(?:(?: version)? 1 0)?
busl-1.1 | business | business source licen[cs]e(?: 1 1)?
unlicense | unlicense | the unlicense|unlicense
wtfpl | wtfpl | wtfpl(?: version 2)?
python-2.0 | python | python software foundation licen[cs]e(?: version 2)?
ruby | ruby | ruby licen[cs]e
php-3.01 | php | php licen[cs]e(?: version)?(?: 3 01)?
openssl | openssl | openssl licen[cs]e
postgresql | postgresql | postgresql licen[cs]e
ncsa | ncsa | (?:university of illinois )?ncsa open source licen[cs]e
ms-pl | microsoft | microsoft public licen[cs]e
ms-rl | microsoft | microsoft reciprocal licen[cs]e
osl-3.0 | open | open software licen[cs]e(?:(?: version| v)? ?3(?: 0)?)?
afl-3.0 | academic | academic free licen[cs]e(?:(?: version| v)? ?3(?: 0)?)?
upl-1.0 | universal | universal permissive licen[cs]e
ecl-2.0 | educational | educational community licen[cs]e
ofl-1.1 | sil | sil open font licen[cs]e(?:(?: version)? 1 1)?
odbl-1.0 | database | open (?:data commons open )?database licen[cs]e(?: odbl)?(?: v?1 0)?
odc-by-1.0 | attribution | open data commons attribution licen[cs]e
pddl-1.0 | dedication | public domain dedication and licen[cs]e
sspl-1.0 | server | server side public licen[cs]e
elastic-2.0 | elastic | elastic licen[cs]e(?: 2 0)?
commons-clause | commons | commons clause
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc-by-1.0 | cc | cc by 1 0
cc-by-2.0 | cc | cc by 2 0
cc-by-2.5 | cc | cc by 2 5
cc-by-3.0 | cc | cc by 3 0
cc-by-4.0 | cc | cc by 4 0
cc-by-sa-2.0 | cc | cc by sa 2 0
cc-by-sa-2.5 | cc | cc by sa 2 5
cc-by-sa-3.0 | cc | cc by sa 3 0
cc-by-sa-4.0 | cc | cc by sa 4 0
cc-by-nd-3.0 | cc | cc by nd 3 0
cc-by-nd-4.0 | cc | cc by nd 4 0
cc-by-nc-2.0 | cc | cc by nc 2 0
cc-by-nc-3.0 | cc | cc by nc 3 0
cc-by-nc-4.0 | cc | cc by nc 4 0
cc-by-nc-sa-3.0 | cc | cc by nc sa 3 0
cc-by-nc-sa-4.0 | cc | cc by nc sa 4 0
cc-by-nc-nd-3.0 | cc | cc by nc nd 3 0
cc-by-nc-nd-4.0 | cc | cc by nc nd 4 0
cc-by | cc | cc by
cc-by-sa | cc | cc by sa
cc-by-nc | cc | cc by nc
cc-by-4.0 | creative | creative commons attribution(?: licen[cs]e)?(?: international)?(?: version)? 4 0
cc-by-3.0 | creative | creative commons attribution(?: licen[cs]e)?(?: unported)?(?: version)? 3 0
cc-by-sa-4.0 | creative | creative commons attribution share ?alike(?: licen[cs]e)? 4 0
cc-by-sa-3.0 | creative | creative commons attribution share ?alike(?: licen[cs]e)? 3 0
cc-by-nc-4.0 | creative | creative commons attribution non ?commercial(?: licen[cs]e)? 4 0
cc-by-nc-sa-4.0 | creative | creative commons attribution non ?commercial share ?alike(?: licen[cs]e)? 4 0
cc-by-nc-nd-4.0 | creative | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: licen[cs]e)? 4 0
cc | creative | creative commons(?: attribution)?(?: licen[cs]e)?
public-domain | public | (?:in|into|to) the public domain
proprietary | rights | all rights reserved
"""

# label | keyword | a passage of the licence's text or its address
PASSAGES = r"""
mit | permission | permission is hereby granted free of charge to any person obtaining a copy
mit | software | the software is provided as is without warranty of any kind express or implied
isc | permission | permission to use copy modify and or distribute this software for any purpose
bsd | redistribution | redistribution and use in source and binary forms with or without modification
bsd-3-clause | endorse | may be used to endorse or promote products derived from this software
apache-2.0 | compliance | you may not use this file except in compliance with the licen[cs]e
apache-2.0 | apache | apache org licenses licen[cs]e 2 0
gpl | redistribute | you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl | gnu | (?:www )?gnu org licenses gpl(?: 2 0| 3 0)?
lgpl | gnu | (?:www )?gnu org licenses lgpl(?: 2 1| 3 0)?
agpl-3.0 | gnu | (?:www )?gnu org licenses agpl(?: 3 0)?
mpl-2.0 | mozilla | mozilla org mpl 2 0
mpl-2.0 | source | this source code form is subject to the terms of the mozilla public licen[cs]e
epl-2.0 | eclipse | eclipse org legal epl(?: v20| 2 0)
bsl-1.0 | boost | boost org license 1 0
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | fuck | do what the fuck you want to public licen[cs]e
zlib | altered | altered source versions must be plainly marked as such
cc-by-4.0 | creativecommons | creativecommons org licenses by 4 0
cc-by-3.0 | creativecommons | creativecommons org licenses by 3 0
cc-by-sa-4.0 | creativecommons | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | creativecommons | creativecommons org licenses by sa 3 0
cc-by-nc-4.0 | creativecommons | creativecommons org licenses by nc 4 0
cc-by-nc-sa-4.0 | creativecommons | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | creativecommons | creativecommons org licenses by nc nd 4 0
cc0-1.0 | creativecommons | creativecommons org publicdomain zero 1 0
"""
