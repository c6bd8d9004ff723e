"""License signatures, written by hand: one a line, as label, keyword and regular expression over words
that stand one space apart, below the priority that they have. A keyword is plain text that every
match holds; only texts with it are searched."""

SIGNATURES = r"""
= 100
mit | spdx license identifier mit | spdx license identifier mit(?! 0)
mit-0 | spdx license identifier mit 0 | spdx license identifier mit 0
apache | spdx license identifier apache | spdx license identifier apache(?: [12] [01])?
gpl | spdx license identifier gpl | spdx license identifier gpl [123](?: 0)?(?: or later| only)?
lgpl | spdx license identifier lgpl | spdx license identifier lgpl [23](?: [01])?(?: or later| only)?
agpl | spdx license identifier agpl | spdx license identifier agpl [13](?: 0)?(?: or later| only)?
gfdl | spdx license identifier gfdl | spdx license identifier gfdl 1 [123](?: (?:no )?invariants)?(?: or later| only)?
mpl | spdx license identifier mpl | spdx license identifier mpl [12] [01](?: no copyleft exception)?
epl | spdx license identifier epl | spdx license identifier epl [12] 0
cddl | spdx license identifier cddl | spdx license identifier cddl 1 [01]
bsd-2-clause | spdx license identifier bsd 2 clause | spdx license identifier bsd 2 clause(?: patent| views)?
bsd-3-clause | spdx license identifier bsd 3 clause | spdx license identifier bsd 3 clause(?: clear| lbnl| attribution)?
bsd-4-clause | spdx license identifier bsd 4 clause | spdx license identifier bsd 4 clause(?: uc)?
0bsd | spdx license identifier 0bsd | spdx license identifier 0bsd
isc | spdx license identifier isc | spdx license identifier isc
zlib | spdx license identifier zlib | spdx license identifier zlib(?: acknowledgement)?
boost | spdx license identifier bsl | spdx license identifier bsl 1 0
unlicense | spdx license identifier unlicense | spdx license identifier unlicense
wtfpl | spdx license identifier wtfpl | spdx license identifier wtfpl
artistic | spdx license identifier artistic | spdx license identifier artistic [12] 0(?: perl| cl8)?
cc0 | spdx license identifier cc0 | spdx license identifier cc0 1 0
cc-by | spdx license identifier cc by | spdx license identifier cc by [1234] [05]
cc-by-sa | spdx license identifier cc by sa | spdx license identifier cc by sa [1234] [05]
cc-by-nc | spdx license identifier cc by nc | spdx license identifier cc by nc [1234] [05]
cc-by-nd | spdx license identifier cc by nd | spdx license identifier cc by nd [1234] [05]
ofl | spdx license identifier ofl | spdx license identifier ofl 1 [01](?: (?:no )?rfn)?
eupl | spdx license identifier eupl | spdx license identifier eupl 1 [012]
python | spdx license identifier | spdx license identifier (?:psf|python) 2(?: 0)?
server-side | spdx license identifier sspl | spdx license identifier sspl 1 0
business-source | spdx license identifier busl | spdx license identifier busl 1 1

= 95
mit | free of charge to any person obtaining | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | the above copyright notice and this permission notice | the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software
mit | without restriction including without limitation the rights to use | without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell
bsd | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification(?: are permitted)?
bsd | redistributions of source code must retain | redistributions of source code must retain the above copyright notice this list of conditions
bsd | redistributions in binary form must reproduce | redistributions in binary form must reproduce the above copyright notice this list of conditions
bsd-3-clause | used to endorse or promote products | neither the names? of .{1,120}? may be used to endorse or promote products derived from this software
bsd-4-clause | all advertising materials mentioning | all advertising materials mentioning features or use of this software must display
isc | distribute this software for any purpose | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
0bsd | distribute this software for any purpose | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided
apache | except in compliance with the license | you may not use this file except in compliance with the license
apache | distributed on an as is basis | distributed under the license is distributed on an as is basis without warranties or conditions of any kind
apache | each contributor hereby grants to you | subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide
gpl | under the terms of the gnu general public license | (?:redistribute it and or modify it|copied|distributed) under the terms of the gnu general public license as published by the free software foundation
gpl | see the gnu general public license | see the gnu general public license for more details
gpl | received a copy of the gnu general public license | you should have received a copy of the gnu general public license
gpl | intended to guarantee your freedom to share and change | intended to guarantee your freedom to share and change (?:free software|all versions of a program)
lgpl | under the terms of the gnu lesser general public license | (?:redistribute it and or modify it|copied|distributed) under the terms of the gnu lesser general public license
lgpl | under the terms of the gnu library general public license | (?:redistribute it and or modify it|copied|distributed) under the terms of the gnu library general public license
lgpl | see the gnu lesser general public license | see the gnu lesser general public license for more details
lgpl | received a copy of the gnu lesser general public license | you should have received a copy of the gnu lesser general public license
lgpl | received a copy of the gnu library general public license | you should have received a copy of the gnu library general public license
agpl | under the terms of the gnu affero general public license | (?:redistribute it and or modify it|copied|distributed) under the terms of the gnu affero general public license
agpl | see the gnu affero general public license | see the gnu affero general public license for more details
agpl | received a copy of the gnu affero general public license | you should have received a copy of the gnu affero general public license
agpl | remotely through a computer network | all users interacting with it remotely through a computer network
gfdl | under the terms of the gnu free documentation license | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | with no invariant sections | with no invariant sections (?:with )?no front cover texts and (?:with )?no back cover texts
mpl | this source code form is subject to | this source code form is subject to the terms of the mozilla public license v ?2 0
mpl | a copy of the mpl was not distributed | if a copy of the mpl was not distributed with this file
mpl | the contents of this file are subject to the mozilla | the contents of this file are subject to the mozilla public license version 1 [01]
epl | accompanying materials are made available under | this program and the accompanying materials are made available under the terms of the eclipse public license
cddl | the contents of this file are subject to the terms of the common development | the contents of this file are subject to the terms of the common development and distribution license
zlib | in no event will the authors | in no event will the authors be held liable for any damages arising from the use of this software
zlib | the origin of this software must not be misrepresented | the origin of this software must not be misrepresented
zlib | altered source versions must be plainly marked | altered source versions must be plainly marked as such
boost | organization obtaining a copy of the software and accompanying documentation | any person or organization obtaining a copy of the software and accompanying documentation covered by this license
unlicense | free and unencumbered software | this is free and unencumbered software released into the public domain
unlicense | dedicate any and all copyright interest | dedicate any and all copyright interest in the software to the public domain
wtfpl | you just do what the fuck you want to | you just do what the fuck you want to
artistic | semblance of artistic control | (?:maintains? some )?semblance of artistic control
artistic | under the same terms as perl itself | (?:redistribute it and or modify it )?under the same terms as perl itself
python | python software foundation psf | this license agreement is between the python software foundation psf
postgresql | without a written agreement is hereby granted | without fee and without a written agreement is hereby granted
openssl | for use in the openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
openssl | cryptographic software written by eric young | this product includes cryptographic software written by eric young
w3c | by obtaining using and or copying this work | by obtaining using and or copying this work you the licensee agree
ms-pl | this license governs use of the accompanying software | this license governs use of the accompanying software if you use the software you accept this license
eupl | licensed under the eupl | licensed under the eupl(?: version)? 1 [12]
upl | associated documentation and or data | subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data
ofl | this font software is licensed under | this font software is licensed under the sil open font license
ofl | reserved font name | with reserved font names?
odbl | under the open database license | made available under the open database license
cc0 | waived all copyright and related | (?:has|have) waived all copyright and related or neighboring rights
cc0 | to the extent possible under law | to the extent possible under law .{1,160}? has waived all copyright
cecill | governed by the cecill | this software is governed by the cecill(?: [bc])? license under french law
ncsa | to deal with the software without restriction | to deal with the software without restriction including without limitation the rights
public-domain | into the public domain | (?:hereby )?(?:released|dedicated|placed) into the public domain
public-domain | in the public domain | (?:is|are|was|were|placed) in the public domain
x11 | shall not be used in advertising or otherwise | shall not be used in advertising or otherwise to promote the sale use or other dealings in this software
beerware | you can buy me a beer | you can buy me a beer in return
json | shall be used for good not evil | the software shall be used for good not evil
curl | distribute this software for any purpose | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
libpng | png reference library | the png reference library is supplied as is
ijg | independent jpeg group | this software is based in part on the work of the independent jpeg group
freetype | the freetype project | portions of this software are copyright (?:c )?(?:[0-9]{4} )?the freetype project
unicode | unicode data files | unicode data files (?:and|or) software
icu | icu license | icu license(?: icu [0-9 ]+ and later)?
business-source | change date | on the change date .{0,200}?(?:licensor|license)
server-side | service source code | offering the program as a service .{0,160}? service source code
elastic | hosted or managed service | you may not provide the software to third parties as a hosted or managed service
commons-clause | commons clause | commons clause license condition v1 0

= 85
mit | opensource org licenses mit | (?:www )?opensource org licenses mit(?: license)?
apache | apache org licenses license 2 0 | (?:www )?apache org licenses license 2 0
apache | opensource org licenses apache | opensource org licenses apache 2 0
gpl | gnu org licenses | (?:www )?gnu org licenses (?:old licenses )?gpl(?: [23] 0)?
gpl | opensource org licenses gpl | opensource org licenses gpl(?: license| [23] 0)?
lgpl | gnu org licenses | (?:www )?gnu org licenses (?:old licenses )?lgpl(?: [23] [01])?
agpl | gnu org licenses agpl | (?:www )?gnu org licenses agpl(?: 3 0)?
gfdl | gnu org licenses fdl | (?:www )?gnu org licenses fdl(?: 1 [123])?
mpl | mozilla org | (?:www )?mozilla org (?:en us )?mpl(?: 2 0)?
epl | eclipse org legal epl | (?:www )?eclipse org legal epl (?:v10|v20|2 0)
bsd | opensource org licenses bsd | opensource org licenses bsd(?: license)?
isc | opensource org licenses isc | opensource org licenses isc(?: license)?
boost | boost org license 1 0 | (?:www )?boost org license 1 0
cc0 | creativecommons org publicdomain zero | creativecommons org publicdomain zero 1 0
cc-by | creativecommons org licenses by | creativecommons org licenses by [1234] [05]
cc-by-sa | creativecommons org licenses by sa | creativecommons org licenses by sa [1234] [05]
cc-by-nc | creativecommons org licenses by nc | creativecommons org licenses by nc [1234] [05]
cc-by-nd | creativecommons org licenses by nd | creativecommons org licenses by nd [1234] [05]
cc-by-nc-sa | creativecommons org licenses by nc sa | creativecommons org licenses by nc sa [1234] [05]
cc-by-nc-nd | creativecommons org licenses by nc nd | creativecommons org licenses by nc nd [1234] [05]
public-domain | creativecommons org publicdomain mark | creativecommons org publicdomain mark 1 0
unlicense | unlicense org | (?:www )?unlicense org
wtfpl | wtfpl net | (?:www )?wtfpl net
ofl | scripts sil org ofl | scripts sil org ofl
odbl | opendatacommons org licenses odbl | opendatacommons org licenses odbl
pddl | opendatacommons org licenses pddl | opendatacommons org licenses pddl
elastic | elastic co licensing | (?:www )?elastic co licensing elastic license

= 80
mit | mit license | (?:licensed|released|distributed|available|provided|published|covered|redistributed|shared) under (?:the )?(?:terms of )?(?:the )?mit license
apache | apache license | (?:licensed|released|distributed|available|provided|published|covered|redistributed|shared) under (?:the )?(?:terms of )?(?:the )?apache license(?: (?:version |v ?)?(?:2 0|1 [01]|2))?
apache | apache license version | apache license version (?:2 0|1 [01]|2)
apache | apache software license | (?:the )?apache software license(?: (?:version )?(?:2 0|1 [01]))?
gpl | general public license | (?:gnu )?general public license (?:version |v ?)?[123](?: 0)?(?: or (?:at your option )?(?:any )?later(?: version)?)?
gpl | general public license | (?:licensed|released|distributed|available|provided|published|covered|redistributed|shared) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?general public license
gpl | gnu gpl | (?:under (?:the )?)?gnu gpl(?: (?:version )?v?[23](?: 0)?)?(?: or later)?
lgpl | lesser general public license | (?:gnu )?lesser general public license(?: (?:version |v ?)?(?:2 1|3 0|3))?
lgpl | library general public license | (?:gnu )?library general public license(?: (?:version |v ?)?2(?: 0)?)?
lgpl | gnu lgpl | (?:under (?:the )?)?gnu lgpl(?: (?:version )?v?[23](?: [01])?)?(?: or later)?
agpl | affero general public license | (?:gnu )?affero general public license(?: (?:version |v ?)?[13](?: 0)?)?
gfdl | free documentation license | (?:gnu )?free documentation license(?: (?:version |v ?)?1 [123])?
mpl | mozilla public license | mozilla public license(?: (?:version |v ?)?(?:2 0|1 [01]))?
epl | eclipse public license | eclipse public license(?: (?:version |v ?)?[12] 0)?
cpl | common public license | common public license(?: (?:version |v ?)?1 0)?
cddl | common development and distribution license | common development and distribution license(?: (?:version )?1 [01])?
bsd-2-clause | bsd | (?:simplified|freebsd|2 clause|two clause) bsd license
bsd-2-clause | bsd 2 clause | bsd 2 clause(?: license)?
bsd-3-clause | bsd | (?:new|revised|modified|3 clause|three clause) bsd license
bsd-3-clause | bsd 3 clause | bsd 3 clause(?: license)?
bsd-4-clause | bsd | (?:original|4 clause|four clause) bsd license
bsd-4-clause | bsd 4 clause | bsd 4 clause(?: license)?
0bsd | zero clause | (?:zero clause bsd|bsd zero clause) license
isc | isc license | (?:licensed under (?:the )?)?isc license
zlib | zlib | zlib(?: libpng)? license
boost | boost software license | boost software license(?: (?:version )?1 0)?
artistic | artistic license | artistic license(?: (?:version )?[12] 0)?
python | python software foundation license | python software foundation license(?: version 2)?
python | psf license | psf license(?: agreement)?
postgresql | postgresql licen | postgresql licen[cs]e
openssl | openssl license | openssl license
w3c | w3c software | w3c software (?:and document )?(?:notice and )?license
ms-pl | microsoft public license | microsoft public license
ms-rl | microsoft reciprocal license | microsoft reciprocal license
eupl | european union public licen | european union public licen[cs]e(?: (?:version |v ?)?1 [012])?
upl | universal permissive license | universal permissive license(?: (?:version |v ?)?1 0)?
ofl | open font license | (?:sil )?open font license(?: (?:version )?1 [01])?
odbl | open database license | (?:open data commons )?open database license(?: (?:version |v ?)?1 0)?
odc-by | open data commons attribution license | open data commons attribution license
pddl | public domain dedication and licen | public domain dedication and licen[cs]e
cc0 | creative commons zero | creative commons zero(?: license| v1 0| 1 0)?
cc0 | cc0 | cc0 (?:1 0 )?(?:universal|public domain dedication)
cc-by | creative commons attribution | creative commons attribution(?: [1234] [05])?(?: international| unported| generic)? licen[cs]e
cc-by-sa | creative commons attribution share | creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by-nc | creative commons attribution non | creative commons attribution non ?commercial(?: [1234] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by-nd | creative commons attribution no | creative commons attribution no ?derivatives(?: [1234] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by-nc-sa | share | creative commons attribution non ?commercial share ?alike(?: [1234] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by-nc-nd | creative commons attribution non | creative commons attribution non ?commercial no ?derivatives(?: [1234] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cecill | cecill | cecill(?: [abc])? (?:free software )?license(?: agreement)?
mulan | mulan permissive software license | mulan permissive software license(?: v ?[12])?
server-side | server side public license | server side public license(?: (?:version |v ?)?1)?
business-source | business source license | business source license(?: (?:version )?1 1)?
elastic | elastic license | elastic license(?: (?:version )?2 0)?
blue-oak | blue oak model license | blue oak model license(?: 1 0 0)?
osl | open software license | open software license(?: (?:version |v ?)?[123] [01])?
afl | academic free license | academic free license(?: (?:version |v ?)?[123] [01])?
ecl | educational community license | educational community license(?: (?:version )?[12] 0)?
ncsa | ncsa open source license | (?:university of illinois )?ncsa open source license
vim | vim license | vim license
ruby | ruby license | (?:the )?ruby license
php | php license | php license(?: (?:version )?3 0[01]?)?
qpl | q public license | q public license(?: version 1 0)?
sleepycat | sleepycat license | sleepycat license
ipl | ibm public license | ibm public license(?: (?:version )?1 0)?
apsl | apple public source license | apple public source license(?: (?:version )?[12] [0-9])?
nasa | nasa open source agreement | nasa open source agreement(?: (?:version )?1 3)?
lppl | latex project public license | latex project public license(?: (?:version )?1 [0-3]c?)?
zpl | zope public license | zope public license(?: (?:version )?[12] [01])?
cpal | common public attribution license | common public attribution license(?: (?:version )?1 0)?
rpl | reciprocal public license | reciprocal public license(?: 1 [15])?
ogl | open government licen | open government licen[cs]e(?: v ?[123](?: 0)?)?
polyform | polyform | polyform (?:noncommercial|small business|shield|strict|perimeter|internal use|free trial) license
hippocratic | hippocratic license | hippocratic license(?: [0-9] [0-9])?
llama | community license agreement | llama [0-9 ]*community license agreement
openrail | openrail | (?:creativeml |bigscience )?openrail(?: m)?(?: license)?

= 65
mit | mit license | (?:see|read|copy of) (?:the )?mit license(?: file| text)?(?: for details)?
apache | apache license | (?:see|read|copy of) (?:the )?apache license(?: file| text)?(?: for details)?
gpl | general public license | (?:see|read|copy of) (?:the )?(?:gnu )?general public license(?: file| text)?(?: for details)?
bsd | bsd license | (?:see|read|copy of) (?:the )?bsd license(?: file| text)?(?: for details)?

= 60
mit | mit license | mit license
mit | expat license | expat license
mit-0 | mit no attribution | mit no attribution(?: license)?
apache | apache license | apache license
gpl | general public license | (?:gnu )?general public license
gpl | gplv | gplv[23](?: or later)?
lgpl | lgplv | lgplv[23](?: [01])?
agpl | agplv | agplv3
mpl | mplv2 | mplv2
bsd | bsd | bsd (?:style )?license
isc | isc licensed | isc licensed
unlicense | the unlicense | the unlicense
wtfpl | do what the fuck you want to public license | do what the fuck you want to public license
dual | dual licensed | dual licensed under

= 20
proprietary | all rights reserved | all rights reserved
proprietary | confidential and proprietary | confidential and proprietary
proprietary | may not be reproduced | may not be reproduced (?:in whole or in part )?without (?:the )?(?:prior )?(?:written )?permission
copyright | copyright | copyright (?:c )?[0-9]{4}(?: [0-9]{4})?
copyright | c copyright | c copyright [0-9]{4}
"""
