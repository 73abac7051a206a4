"""Hand-written license signatures: label | priority | keyword | pattern.

Patterns see a text as its words in lower case (digits, a-z and everything
beyond ASCII), one space apart, and match whole words.  The keyword is a plain
string that every match holds; it is looked for before the pattern is.
Priority 1: identifiers and grants; 2: names with a version; 3: names;
4: mentions that need company.
"""

RULES_TEXT = """
mit | 1 | identifier mit | spdx license identifier mit
mit | 1 | mit license | (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?mit license
mit | 2 | opensource org licenses mit | opensource org licenses mit
mit | 2 | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 3 | mit license | (?:the )?mit license
mit | 3 | mit licence | (?:the )?mit licence
mit | 3 | expat license | expat license
mit | 4 | mit licensed | mit licensed
mit-0 | 1 | identifier mit 0 | spdx license identifier mit 0
mit-0 | 2 | mit no attribution | mit no attribution(?: license)?
x11 | 1 | identifier x11 | spdx license identifier x11
x11 | 3 | x11 license | x11 license
isc | 1 | identifier isc | spdx license identifier isc
isc | 1 | permission to use copy modify and | permission to use copy modify and or distribute this software for any purpose with or without fee
isc | 3 | isc license | isc license
0bsd | 1 | identifier 0bsd | spdx license identifier 0bsd
0bsd | 3 | zero clause bsd | (?:bsd )?zero clause bsd(?: license)?
apache | 1 | identifier apache | spdx license identifier apache(?: 1 [01]| 2 0)?
apache | 1 | apache license | (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?apache license(?: version [12](?: [01])?)?
apache | 2 | apache org licenses license | apache org licenses license(?: [12] [01])?
apache | 2 | apache license version | apache license version [12](?: [01])?
apache | 2 | apache license 2 | apache license 2 0
apache | 2 | apache 2 0 | apache 2 0 licen[sc]ed?
apache | 2 | asl 2 0 | asl 2 0
apache | 3 | apache license | (?:the )?apache license
apache | 3 | apache software license | apache software license(?: [12] [01])?
apache | 3 | apache licence | apache licence
apache | 4 | apache licensed | apache licensed
gpl-1.0 | 1 | identifier gpl 1 | spdx license identifier gpl 1 0(?: only| or later)?
gpl-1.0 | 2 | general public license version 1 | (?:gnu )?general public license version 1(?: 0)?
gpl-2.0 | 1 | identifier gpl 2 | spdx license identifier gpl 2 0(?: only| or later)?
gpl-2.0 | 1 | general public license version 2 | under the (?:terms of the )?gnu general public license version 2(?: 0)?
gpl-2.0 | 2 | general public license version 2 | (?:gnu )?general public license version 2(?: 0)?
gpl-2.0 | 2 | general public license v2 | (?:gnu )?general public license v2
gpl-2.0 | 2 | gnu org licenses old licenses gpl 2 | gnu org licenses old licenses gpl 2 0
gpl-2.0 | 2 | gplv2 | gplv2
gpl-2.0 | 2 | gpl 2 0 | gpl 2 0(?: only)?
gpl-2.0-or-later | 1 | either version 2 of the license or | either version 2 of the license or (?:at your option )?any later version
gpl-2.0-or-later | 2 | gpl 2 0 or later | gpl 2 0 or later
gpl-2.0-or-later | 2 | gplv2 or later | gplv2 or later
gpl-3.0 | 1 | identifier gpl 3 | spdx license identifier gpl 3 0(?: only| or later)?
gpl-3.0 | 1 | general public license version 3 | under the (?:terms of the )?gnu general public license version 3(?: 0)?
gpl-3.0 | 2 | general public license version 3 | (?:gnu )?general public license version 3(?: 0)?
gpl-3.0 | 2 | general public license v3 | (?:gnu )?general public license v3
gpl-3.0 | 2 | gnu org licenses gpl 3 | gnu org licenses gpl 3 0
gpl-3.0 | 2 | gplv3 | gplv3
gpl-3.0 | 2 | gpl 3 0 | gpl 3 0(?: only)?
gpl-3.0-or-later | 1 | either version 3 of the license or | either version 3 of the license or (?:at your option )?any later version
gpl-3.0-or-later | 2 | gpl 3 0 or later | gpl 3 0 or later
gpl-3.0-or-later | 2 | gplv3 or later | gplv3 or later
gpl | 3 | general public license | (?:the )?(?:gnu )?general public license
gpl | 3 | general public licence | (?:the )?(?:gnu )?general public licence
gpl | 3 | gnu gpl | gnu gpl
gpl | 3 | gnu org licenses gpl | gnu org licenses gpl(?: html)?
gpl | 4 | gpl licensed | gpl licensed
gpl | 4 | gpl license | gpl licensed?
lgpl-2.0 | 1 | identifier lgpl 2 0 | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.0 | 2 | library general public license | gnu library general public license(?: version 2(?: 0)?)?
lgpl-2.1 | 1 | identifier lgpl 2 1 | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-2.1 | 2 | lesser general public license version 2 | (?:gnu )?lesser general public license version 2(?: 1)?
lgpl-2.1 | 2 | lgpl 2 1 | lgpl 2 1(?: or later| only)?
lgpl-2.1 | 2 | lgplv2 1 | lgplv2 1
lgpl-3.0 | 1 | identifier lgpl 3 | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-3.0 | 2 | lesser general public license version 3 | (?:gnu )?lesser general public license version 3(?: 0)?
lgpl-3.0 | 2 | lgpl 3 0 | lgpl 3 0(?: or later| only)?
lgpl-3.0 | 2 | lgplv3 | lgplv3
lgpl | 3 | lesser general public license | (?:the )?(?:gnu )?lesser general public license
lgpl | 3 | gnu lgpl | gnu lgpl
agpl-3.0 | 1 | identifier agpl 3 | spdx license identifier agpl 3 0(?: only| or later)?
agpl-3.0 | 2 | affero general public license version 3 | (?:gnu )?affero general public license version 3(?: 0)?
agpl-3.0 | 2 | agpl 3 0 | agpl 3 0(?: or later| only)?
agpl-3.0 | 2 | agplv3 | agplv3
agpl-1.0 | 1 | identifier agpl 1 | spdx license identifier agpl 1 0(?: only| or later)?
agpl | 3 | affero general public license | (?:the )?(?:gnu )?affero general public license
agpl | 3 | gnu agpl | gnu agpl
gfdl | 1 | identifier gfdl | spdx license identifier gfdl 1 [123](?: only| or later)?
gfdl | 2 | free documentation license version | gnu free documentation license version 1 [123]
gfdl | 3 | free documentation license | gnu free documentation license
bsd-2-clause | 1 | identifier bsd 2 | spdx license identifier bsd 2 clause
bsd-2-clause | 2 | bsd 2 clause | bsd 2 clause(?: license)?
bsd-2-clause | 2 | 2 clause bsd | 2 clause bsd(?: license)?
bsd-2-clause | 2 | simplified bsd | simplified bsd license
bsd-2-clause | 2 | opensource org licenses bsd 2 | opensource org licenses bsd 2 clause
bsd-3-clause | 1 | identifier bsd 3 | spdx license identifier bsd 3 clause
bsd-3-clause | 1 | neither the name of | neither the name of (?:the )?[^ ]+(?: [^ ]+){0,8} nor the names of its contributors
bsd-3-clause | 2 | bsd 3 clause | bsd 3 clause(?: license)?
bsd-3-clause | 2 | 3 clause bsd | 3 clause bsd(?: license)?
bsd-3-clause | 2 | new bsd license | new bsd license
bsd-3-clause | 2 | modified bsd license | modified bsd license
bsd-3-clause | 2 | opensource org licenses bsd 3 | opensource org licenses bsd 3 clause
bsd-4-clause | 1 | identifier bsd 4 | spdx license identifier bsd 4 clause
bsd-4-clause | 1 | all advertising materials mentioning features | all advertising materials mentioning features or use of this software
bsd-4-clause | 2 | original bsd license | original bsd license
bsd-4-clause | 2 | bsd 4 clause | bsd 4 clause(?: license)?
bsd | 1 | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted
bsd | 3 | bsd license | bsd licensed?
bsd | 3 | bsd style license | bsd style license
bsd | 3 | berkeley software distribution license | berkeley software distribution license
mpl-1.0 | 1 | identifier mpl 1 0 | spdx license identifier mpl 1 0
mpl-1.1 | 1 | identifier mpl 1 1 | spdx license identifier mpl 1 1
mpl-1.1 | 2 | mozilla public license version 1 | mozilla public license version 1 1
mpl-1.1 | 2 | mpl 1 1 | mpl 1 1
mpl-2.0 | 1 | identifier mpl 2 | spdx license identifier mpl 2 0
mpl-2.0 | 1 | subject to the terms of the mozilla public license | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 2 | mozilla public license version 2 | mozilla public license version 2(?: 0)?
mpl-2.0 | 2 | mozilla public license v 2 | mozilla public license v 2 0
mpl-2.0 | 2 | mozilla org mpl 2 | mozilla org mpl 2 0
mpl-2.0 | 2 | mpl 2 0 | mpl 2 0
mpl | 3 | mozilla public license | mozilla public license
epl-1.0 | 1 | identifier epl 1 | spdx license identifier epl 1 0
epl-1.0 | 2 | eclipse public license | eclipse public license (?:version |v )1 0
epl-2.0 | 1 | identifier epl 2 | spdx license identifier epl 2 0
epl-2.0 | 2 | eclipse public license version 2 | eclipse public license version 2 0
epl-2.0 | 2 | eclipse public license v 2 | eclipse public license v 2 0
epl-2.0 | 2 | eclipse org legal epl 2 | eclipse org legal epl 2 0
epl | 3 | eclipse public license | eclipse public license
edl | 3 | eclipse distribution license | eclipse distribution license(?: v 1 0)?
cddl-1.0 | 1 | identifier cddl 1 0 | spdx license identifier cddl 1 0
cddl-1.1 | 1 | identifier cddl 1 1 | spdx license identifier cddl 1 1
cddl | 2 | common development and distribution license version | common development and distribution license version 1 [01]
cddl | 3 | common development and distribution license | common development and distribution license
cpl | 2 | common public license version | common public license version 1 0
cpl | 3 | common public license | common public license
ipl | 3 | ibm public license | ibm public license(?: version 1 0)?
apsl | 2 | apple public source license version | apple public source license version [12](?: [012])?
apsl | 3 | apple public source license | apple public source license
artistic-1.0 | 1 | identifier artistic 1 | spdx license identifier artistic 1 0
artistic-2.0 | 1 | identifier artistic 2 | spdx license identifier artistic 2 0
artistic-2.0 | 2 | artistic license 2 | artistic license 2 0
artistic | 3 | artistic license | (?:perl )?artistic license
perl | 1 | same terms as perl itself | under the same terms as perl itself
python | 1 | identifier python 2 | spdx license identifier python 2 0
python | 2 | python software foundation license version | python software foundation license version 2
python | 3 | python software foundation license | python software foundation license
psf | 3 | psf license | psf license(?: agreement)?
php | 2 | php license version | php license version 3 0[01]?
php | 3 | php license | php license
ruby | 3 | ruby license | ruby license
zlib | 1 | identifier zlib | spdx license identifier zlib
zlib | 1 | provided as is without any express or implied warranty in no event | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | 3 | zlib license | zlib license
zlib | 3 | zlib libpng license | zlib libpng license
libpng | 3 | libpng license | libpng license(?: version 2)?
openssl | 1 | identifier openssl | spdx license identifier openssl
openssl | 3 | openssl license | openssl license
ssleay | 3 | ssleay license | (?:original )?ssleay license
curl | 3 | curl license | curl license
ntp | 3 | ntp license | ntp license
ncsa | 1 | identifier ncsa | spdx license identifier ncsa
ncsa | 3 | ncsa open source license | (?:university of illinois )?ncsa open source license
postgresql | 1 | identifier postgresql | spdx license identifier postgresql
postgresql | 3 | postgresql license | postgresql license
unlicense | 1 | identifier unlicense | spdx license identifier unlicense
unlicense | 1 | free and unencumbered software | this is free and unencumbered software released into the public domain
unlicense | 3 | the unlicense | the unlicense
wtfpl | 1 | identifier wtfpl | spdx license identifier wtfpl
wtfpl | 3 | what the fuck you want to public license | do what the fuck you want to public license
wtfpl | 3 | wtfpl license | wtfpl license
beerware | 3 | beerware license | beerware license
bsl-1.0 | 1 | identifier bsl 1 0 | spdx license identifier bsl 1 0
bsl-1.0 | 2 | boost software license version | boost software license version 1 0
bsl-1.0 | 2 | boost org license 1 0 | boost org license 1 0 txt
bsl-1.0 | 3 | boost software license | boost software license
busl-1.1 | 1 | identifier busl 1 1 | spdx license identifier busl 1 1
busl-1.1 | 2 | business source license 1 1 | business source license 1 1
busl-1.1 | 3 | business source license | business source license
sspl | 1 | identifier sspl | spdx license identifier sspl 1 0
sspl | 3 | server side public license | server side public license(?: version 1)?
elastic | 1 | identifier elastic 2 | spdx license identifier elastic 2 0
elastic | 2 | elastic license 2 | elastic license 2 0
elastic | 3 | elastic license | elastic license
commons-clause | 3 | commons clause license | commons clause license(?: condition)?(?: v1 0)?
polyform | 2 | polyform noncommercial license | polyform noncommercial license(?: 1 0 0)?
polyform | 2 | polyform shield license | polyform shield license(?: 1 0 0)?
polyform | 2 | polyform small business license | polyform small business license(?: 1 0 0)?
confluent | 3 | confluent community license | confluent community license
eupl | 1 | identifier eupl | spdx license identifier eupl 1 [012]
eupl | 2 | european union public licence v | european union public licence v 1 [012]
eupl | 3 | european union public licence | european union public licence
cecill | 1 | identifier cecill | spdx license identifier cecill(?: [bc]| [12] [01])?
cecill | 3 | cecill license | cecill license
cecill | 3 | cecill b license | cecill b license
cecill | 3 | cecill c license | cecill c license
afl | 2 | academic free license version | academic free license version [123] [01]
afl | 3 | academic free license | academic free license
osl | 2 | open software license version | open software license version [123] [01]
osl | 3 | open software license | open software license
opl | 3 | open publication license | open publication license
upl | 3 | universal permissive license | universal permissive license(?: v 1 0)?
ms-pl | 1 | identifier ms pl | spdx license identifier ms pl
ms-pl | 3 | microsoft public license | microsoft public license
ms-rl | 1 | identifier ms rl | spdx license identifier ms rl
ms-rl | 3 | microsoft reciprocal license | microsoft reciprocal license
npl | 3 | netscape public license | netscape public license(?: version 1 [01])?
sunpl | 3 | sun public license | sun public license(?: version 1 0)?
qpl | 3 | q public license | q public license(?: version 1 0)?
sleepycat | 3 | sleepycat license | sleepycat license
vim | 3 | vim license | vim license
w3c | 3 | w3c software notice and license | w3c software notice and license
w3c | 3 | w3c license | w3c license
unicode | 3 | unicode license | unicode license(?: agreement)?
icu | 3 | icu license | icu license
tcl | 3 | tcl license | tcl license
tcl | 3 | tcl tk license | tcl tk license
lppl | 1 | identifier lppl | spdx license identifier lppl 1 [0123][ac]?
lppl | 2 | latex project public license version | latex project public license version 1 [0123]
lppl | 3 | latex project public license | latex project public license
ofl | 1 | identifier ofl | spdx license identifier ofl 1 [01]
ofl | 2 | sil open font license version | sil open font license version 1 [01]
ofl | 3 | open font license | (?:sil )?open font license
bitstream | 3 | bitstream vera license | bitstream vera license
cc0 | 1 | identifier cc0 | spdx license identifier cc0 1 0
cc0 | 2 | publicdomain zero 1 0 | creativecommons org publicdomain zero 1 0
cc0 | 2 | cc0 1 0 | cc0 1 0(?: universal)?
cc0 | 3 | cc0 license | cc0 license
cc-by | 1 | identifier cc by | spdx license identifier cc by [1234] [05]
cc-by | 1 | under cc by | (?:licensed|released|available) under cc by(?: [1234] [05])?
cc-by | 2 | creativecommons org licenses by | creativecommons org licenses by [1234] [05]
cc-by | 2 | creative commons attribution | creative commons attribution (?:[1234] [05] )?(?:international |unported |generic )?license
cc-by | 2 | cc by | cc by [1234] [05]
cc-by-sa | 1 | identifier cc by sa | spdx license identifier cc by sa [1234] [05]
cc-by-sa | 1 | under cc by sa | (?:licensed|released|available) under cc by sa(?: [1234] [05])?
cc-by-sa | 2 | creativecommons org licenses by sa | creativecommons org licenses by sa [1234] [05]
cc-by-sa | 2 | creative commons attribution sharealike | creative commons attribution sharealike (?:[1234] [05] )?(?:international |unported )?license
cc-by-sa | 2 | cc by sa | cc by sa(?: [1234] [05])?
cc-by-nc | 1 | identifier cc by nc | spdx license identifier cc by nc [1234] [05]
cc-by-nc | 1 | under cc by nc | (?:licensed|released|available) under cc by nc(?: [1234] [05])?
cc-by-nc | 2 | creativecommons org licenses by nc | creativecommons org licenses by nc [1234] [05]
cc-by-nc | 2 | creative commons attribution noncommercial | creative commons attribution noncommercial (?:[1234] [05] )?(?:international |unported )?license
cc-by-nc | 2 | cc by nc | cc by nc(?: [1234] [05])?
cc-by-nd | 1 | under cc by nd | (?:licensed|released|available) under cc by nd(?: [1234] [05])?
cc-by-nd | 2 | creativecommons org licenses by nd | creativecommons org licenses by nd [1234] [05]
cc-by-nd | 2 | cc by nd | cc by nd(?: [1234] [05])?
cc-by-nc-sa | 1 | under cc by nc sa | (?:licensed|released|available) under cc by nc sa(?: [1234] [05])?
cc-by-nc-sa | 2 | creativecommons org licenses by nc sa | creativecommons org licenses by nc sa [1234] [05]
cc-by-nc-sa | 2 | cc by nc sa | cc by nc sa(?: [1234] [05])?
cc-by-nc-nd | 1 | under cc by nc nd | (?:licensed|released|available) under cc by nc nd(?: [1234] [05])?
cc-by-nc-nd | 2 | creativecommons org licenses by nc nd | creativecommons org licenses by nc nd [1234] [05]
cc-by-nc-nd | 2 | cc by nc nd | cc by nc nd(?: [1234] [05])?
cc | 3 | creative commons licen | creative commons licen[sc]e
odbl | 1 | identifier odbl | spdx license identifier odbl 1 0
odbl | 3 | open database license | open database license(?: v 1 0| 1 0)?
odc-by | 3 | open data commons attribution license | open data commons attribution license(?: v 1 0)?
pddl | 3 | public domain dedication and license | (?:open data commons )?public domain dedication and license
cdla | 2 | community data license agreement permissive | community data license agreement permissive(?: version)?(?: [12] 0)?
cdla | 2 | community data license agreement sharing | community data license agreement sharing(?: version)?(?: 1 0)?
ogl-uk | 3 | open government licence | open government licence(?: v ?[123] 0)?
openrail | 2 | creativeml open rail | creativeml open rail m(?: license)?
openrail | 2 | bigscience openrail | bigscience openrail m(?: license)?
openrail | 3 | openrail license | openrail license
llama | 3 | llama 2 community license | llama 2 community license(?: agreement)?
llama | 3 | llama 3 community license | llama 3 community license(?: agreement)?
gemma | 3 | gemma terms of use | gemma terms of use
public-domain | 1 | dedicated to the public domain | (?:is |are )?(?:hereby )?dedicated to the public domain
public-domain | 1 | placed in the public domain | (?:is |are |been )?placed in the public domain
public-domain | 3 | in the public domain | in the public domain
proprietary | 2 | all rights reserved | all rights reserved
proprietary | 3 | proprietary license | proprietary licensed?
proprietary | 3 | commercial license | commercial license(?: agreement)?
eula | 3 | end user license agreement | end user license agreement
gpl-1.0 | 2 | gpl | (?:(?:under (?:the )?(?:terms of the )?)?(?:gnu )?gpl (?:(?:v ?|version )1(?: 0)?|1 0)|under (?:the )?(?:terms of the )?(?:gnu )?gpl 1)(?: only| or later)?
gpl-2.0 | 2 | gpl | (?:(?:under (?:the )?(?:terms of the )?)?(?:gnu )?gpl (?:(?:v ?|version )2(?: 0)?|2 0)|under (?:the )?(?:terms of the )?(?:gnu )?gpl 2)(?: only)?
gpl-2.0-or-later | 2 | gpl | (?:(?:under (?:the )?(?:terms of the )?)?(?:gnu )?gpl (?:(?:v ?|version )2(?: 0)?|2 0)|under (?:the )?(?:terms of the )?(?:gnu )?gpl 2) or (?:at your option )?(?:any )?later(?: version)?
gpl-3.0 | 2 | gpl | (?:(?:under (?:the )?(?:terms of the )?)?(?:gnu )?gpl (?:(?:v ?|version )3(?: 0)?|3 0)|under (?:the )?(?:terms of the )?(?:gnu )?gpl 3)(?: only)?
gpl-3.0-or-later | 2 | gpl | (?:(?:under (?:the )?(?:terms of the )?)?(?:gnu )?gpl (?:(?:v ?|version )3(?: 0)?|3 0)|under (?:the )?(?:terms of the )?(?:gnu )?gpl 3) or (?:at your option )?(?:any )?later(?: version)?
gpl | 3 | gpl | under (?:the )?(?:terms of the )?(?:gnu )?gpl
lgpl-2.0 | 2 | lgpl | (?:(?:under (?:the )?(?:terms of the )?)?(?:gnu )?lgpl (?:(?:v ?|version )2(?: 0)?|2 0)|under (?:the )?(?:terms of the )?(?:gnu )?lgpl 2)(?: only| or later)?
lgpl-2.1 | 2 | lgpl | (?:under (?:the )?(?:terms of the )?)?(?:gnu )?lgpl (?:v ?|version )?2 1(?: only| or later)?
lgpl-3.0 | 2 | lgpl | (?:(?:under (?:the )?(?:terms of the )?)?(?:gnu )?lgpl (?:(?:v ?|version )3(?: 0)?|3 0)|under (?:the )?(?:terms of the )?(?:gnu )?lgpl 3)(?: only| or later)?
lgpl | 3 | lgpl | under (?:the )?(?:terms of the )?(?:gnu )?lgpl
agpl-1.0 | 2 | agpl | (?:(?:under (?:the )?(?:terms of the )?)?(?:gnu )?agpl (?:(?:v ?|version )1(?: 0)?|1 0)|under (?:the )?(?:terms of the )?(?:gnu )?agpl 1)(?: only| or later)?
agpl-3.0 | 2 | agpl | (?:(?:under (?:the )?(?:terms of the )?)?(?:gnu )?agpl (?:(?:v ?|version )3(?: 0)?|3 0)|under (?:the )?(?:terms of the )?(?:gnu )?agpl 3)(?: only| or later)?
agpl | 3 | agpl | under (?:the )?(?:terms of the )?(?:gnu )?agpl
mit | 1 | licensed under mit | licensed under mit(?! no attribution)(?! 0 )
mit | 4 | under mit | (?:released|distributed|available|published|provided) under mit(?! no attribution)(?! 0 )
mit | 1 | licensed under the mit | licensed under the mit(?! no attribution)(?! 0 )
mit | 4 | under the mit | (?:released|distributed|available|published|provided) under the mit(?! no attribution)(?! 0 )
mit | 1 | licensed under the terms of the mit | licensed under the terms of the mit(?! no attribution)(?! 0 )
mit | 4 | under the terms of the mit | (?:released|distributed|available|published|provided) under the terms of the mit(?! no attribution)(?! 0 )
apache | 4 | apache 2 0 | apache 2 0(?! [0-9])(?! (?:web |http )?server)(?! httpd)
apache | 4 | apache v2 | apache v2(?: 0)?(?: licen[sc]ed?)?(?! [0-9])(?! (?:web |http )?server)(?! httpd)
apache | 4 | apache version 2 | apache version 2(?: 0)?(?: licen[sc]ed?)?(?! [0-9])(?! (?:web |http )?server)(?! httpd)
"""


def parsed(text: str = RULES_TEXT) -> list[tuple[str, int, str, str]]:
    """(label, priority, keyword, pattern) in order."""
    rows = [[f.strip() for f in line.split("|", 3)] for line in text.strip().splitlines()]
    return [(label, int(priority), keyword, pattern) for label, priority, keyword, pattern in rows]
