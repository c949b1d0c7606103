"""Signature rules of the license scan, written by hand, in order.

Every line is ``label | kind | keyword | expression``. Expressions are matched on words in lower case with single spaces between them (signs are gone:
``2.0`` is ``2 0``), from word to word. A keyword is a part of every text that its expression can match.
"""

RULES = r"""
# identifiers that files carry for tools
apache-2.0 | spdx | spdx license identifier | spdx license identifier apache 2 0
apache-1.1 | spdx | spdx license identifier | spdx license identifier apache 1 1
mit | spdx | spdx license identifier | spdx license identifier mit(?! 0| modern)
mit-0 | spdx | spdx license identifier | spdx license identifier mit 0
bsd-2-clause | spdx | spdx license identifier | spdx license identifier bsd 2 clause
bsd-3-clause | spdx | spdx license identifier | spdx license identifier bsd 3 clause
bsd-4-clause | spdx | spdx license identifier | spdx license identifier bsd 4 clause
0bsd | spdx | spdx license identifier | spdx license identifier 0bsd
gpl-2.0-only | spdx | spdx license identifier | spdx license identifier gpl 2 0(?: only)?(?! or later)
gpl-2.0-or-later | spdx | spdx license identifier | spdx license identifier gpl 2 0 or later
gpl-3.0-only | spdx | spdx license identifier | spdx license identifier gpl 3 0(?: only)?(?! or later)
gpl-3.0-or-later | spdx | spdx license identifier | spdx license identifier gpl 3 0 or later
lgpl-2.1 | spdx | spdx license identifier | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 | spdx | spdx license identifier | spdx license identifier lgpl 3 0(?: only| or later)?
agpl-3.0 | spdx | spdx license identifier | spdx license identifier agpl 3 0(?: only| or later)?
mpl-2.0 | spdx | spdx license identifier | spdx license identifier mpl 2 0(?: no copyleft exception)?
mpl-1.1 | spdx | spdx license identifier | spdx license identifier mpl 1 1
epl-1.0 | spdx | spdx license identifier | spdx license identifier epl 1 0
epl-2.0 | spdx | spdx license identifier | spdx license identifier epl 2 0
eupl-1.2 | spdx | spdx license identifier | spdx license identifier eupl 1 2
isc | spdx | spdx license identifier | spdx license identifier isc
zlib | spdx | spdx license identifier | spdx license identifier zlib
unlicense | spdx | spdx license identifier | spdx license identifier unlicense
cc0-1.0 | spdx | spdx license identifier | spdx license identifier cc0 1 0
cc-by-4.0 | spdx | spdx license identifier | spdx license identifier cc by 4 0
cc-by-sa-4.0 | spdx | spdx license identifier | spdx license identifier cc by sa 4 0
cc-by-nc-4.0 | spdx | spdx license identifier | spdx license identifier cc by nc 4 0
bsl-1.0 | spdx | spdx license identifier | spdx license identifier bsl 1 0
busl-1.1 | spdx | spdx license identifier | spdx license identifier busl 1 1
sspl-1.0 | spdx | spdx license identifier | spdx license identifier sspl 1 0
artistic-2.0 | spdx | spdx license identifier | spdx license identifier artistic 2 0
wtfpl | spdx | spdx license identifier | spdx license identifier wtfpl
postgresql | spdx | spdx license identifier | spdx license identifier postgresql
python-2.0 | spdx | spdx license identifier | spdx license identifier (?:python 2 0|psf 2 0)
ofl-1.1 | spdx | spdx license identifier | spdx license identifier ofl 1 1
other-spdx | spdx | spdx license identifier | spdx license identifier [a-z0-9]+

# addresses of license texts
apache-2.0 | url | apache org licenses | (?:www )?apache org licenses license 2 0
apache-1.1 | url | apache org licenses | (?:www )?apache org licenses license 1 1
mit | url | opensource org | opensource org licenses? mit(?: license)?(?: php| html)?
bsd-2-clause | url | opensource org | opensource org licenses? bsd 2 clause
bsd-3-clause | url | opensource org | opensource org licenses? bsd 3 clause
isc | url | opensource org | opensource org licenses? isc
osl-3.0 | url | opensource org | opensource org licenses? osl 3 0
afl-3.0 | url | opensource org | opensource org licenses? afl 3 0
gpl-2.0 | url | gnu org | (?:www )?gnu org (?:licenses|copyleft) (?:old licenses )?gpl 2 0
gpl-3.0 | url | gnu org | (?:www )?gnu org (?:licenses|copyleft) gpl(?: 3 0)?(?: html| txt)?
lgpl-2.1 | url | gnu org | (?:www )?gnu org (?:licenses|copyleft) (?:old licenses )?lgpl 2 1
lgpl-3.0 | url | gnu org | (?:www )?gnu org (?:licenses|copyleft) lgpl(?: 3 0)?(?: html| txt)?
agpl-3.0 | url | gnu org | (?:www )?gnu org (?:licenses|copyleft) agpl(?: 3 0)?
fdl-1.3 | url | gnu org | (?:www )?gnu org (?:licenses|copyleft) fdl(?: 1 3)?
mpl-2.0 | url | mozilla org | (?:www )?mozilla org (?:en us )?mpl 2 0
mpl-1.1 | url | mozilla org | (?:www )?mozilla org (?:en us )?mpl 1 1
epl-1.0 | url | eclipse org | (?:www )?eclipse org legal epl v10
epl-2.0 | url | eclipse org | (?:www )?eclipse org legal epl (?:v20|2 0)
cddl-1.0 | url | cddl | (?:glassfish|sun|opensource)(?: [a-z0-9]+){1,5} cddl(?: 1 0)?
bsl-1.0 | url | license 1 0 txt | (?:www )?boost org license 1 0 txt
unlicense | url | unlicense org | unlicense org
wtfpl | url | wtfpl net | (?:www )?wtfpl net
cc0-1.0 | url | creativecommons org | creativecommons org publicdomain zero 1 0
public-domain | url | creativecommons org | creativecommons org publicdomain mark 1 0
cc-by-4.0 | url | creativecommons org | creativecommons org licenses by 4 0
cc-by-3.0 | url | creativecommons org | creativecommons org licenses by 3 0
cc-by-2.5 | url | creativecommons org | creativecommons org licenses by 2 5
cc-by-2.0 | url | creativecommons org | creativecommons org licenses by 2 0
cc-by-sa-4.0 | url | creativecommons org | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | url | creativecommons org | creativecommons org licenses by sa 3 0
cc-by-sa-2.5 | url | creativecommons org | creativecommons org licenses by sa 2 5
cc-by-nc-4.0 | url | creativecommons org | creativecommons org licenses by nc 4 0
cc-by-nc-3.0 | url | creativecommons org | creativecommons org licenses by nc 3 0
cc-by-nd-4.0 | url | creativecommons org | creativecommons org licenses by nd 4 0
cc-by-nd-3.0 | url | creativecommons org | creativecommons org licenses by nd 3 0
cc-by-nc-sa-4.0 | url | creativecommons org | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0 | url | creativecommons org | creativecommons org licenses by nc sa 3 0
cc-by-nc-nd-4.0 | url | creativecommons org | creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-3.0 | url | creativecommons org | creativecommons org licenses by nc nd 3 0
ofl-1.1 | url | sil org | scripts sil org ofl
odbl-1.0 | url | opendatacommons org | (?:www )?opendatacommons org licenses odbl(?: 1 0| summary)?
odc-by-1.0 | url | opendatacommons org | (?:www )?opendatacommons org licenses by(?: 1 0| summary)?
pddl-1.0 | url | opendatacommons org | (?:www )?opendatacommons org licenses pddl(?: 1 0| summary)?
eupl-1.2 | url | joinup ec europa eu | joinup ec europa eu(?: [a-z0-9]+){1,6} eupl
ogl-3.0 | url | nationalarchives gov uk | (?:www )?nationalarchives gov uk doc open government licence version 3
artistic-2.0 | url | artistic 2 0 | (?:www )?(?:perlfoundation|opensource) org(?: [a-z0-9]+){0,3} artistic 2 0

# sentences of the license texts themselves
mit | text | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
mit | text | the above copyright notice and this permission notice | the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software
mit-like | text | the software is provided as is without warranty | the software is provided as is without warranty of any kind express or implied
bsl-1.0 | text | permission is hereby granted free of charge | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
x11 | text | shall not be used in advertising | except as contained in this notice the names? of(?: [a-z0-9]+){1,8} shall not be used in advertising or otherwise to promote the sale
hpnd | text | permission to use copy modify and distribute this software and its documentation | permission to use copy modify and distribute this software and its documentation for any purpose(?: and without fee)? is hereby granted
isc | text | permission to use copy modify and or distribute this software | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that
0bsd | text | permission to use copy modify and or distribute this software | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?! provided)
bsd | text | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd | text | redistributions of source code must retain | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | text | redistributions in binary form must reproduce | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause | text | may be used to endorse or promote products | neither the names? of(?: [a-z0-9]+){1,12} nor the names of (?:its|the|any) contributors may be used to endorse or promote products
bsd-4-clause | text | all advertising materials mentioning features | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-like | text | this software is provided by | this software is provided by(?: [a-z0-9]+){1,8} as is and any express or implied warranties
bsd-2-clause-patent | text | subject to the terms and conditions of this license | subject to the terms and conditions of this license each copyright holder and contributor hereby grants
apache-2.0 | text | subject to the terms and conditions of this license | subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license
apache-2.0 | text | you may not use this file except in compliance | you may not use this file except in compliance with the license you may obtain a copy of the license at
apache-2.0 | text | distributed on an as is basis | distributed under the license is distributed on an as is basis without warranties or conditions of any kind
apache-2.0 | text | terms and conditions for use reproduction and distribution | terms and conditions for use reproduction and distribution
apache-1.1 | text | apache software foundation | this product includes software developed by the apache software foundation
gpl | text | this program is free software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl | text | see the gnu general public license for more details | see the gnu general public license for more details
gpl | text | you should have received a copy of the gnu general | you should have received a copy of the gnu general public license
gpl-2.0 | text | gnu general public license version 2 june 1991 | gnu general public license version 2 june 1991
gpl-3.0 | text | gnu general public license version 3 29 june 2007 | gnu general public license version 3 29 june 2007
gpl | text | free copyleft license for software | the gnu general public license is a free copyleft license for software
gpl | text | guarantee your freedom to share and change | guarantee your freedom to share and change (?:free software|all versions of a program)
lgpl | text | this library is free software | this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
lgpl | text | you should have received a copy of the gnu l | you should have received a copy of the gnu (?:lesser|library) general public license
lgpl-2.1 | text | lesser general public license version 2 1 february 1999 | gnu lesser general public license version 2 1 february 1999
lgpl-3.0 | text | lesser general public license version 3 29 june 2007 | gnu lesser general public license version 3 29 june 2007
agpl-3.0 | text | affero general public license version 3 19 november 2007 | gnu affero general public license version 3 19 november 2007
agpl | text | you should have received a copy of the gnu affero | you should have received a copy of the gnu affero general public license
agpl-3.0 | text | interacting with it remotely through a computer network | all users interacting with it remotely through a computer network
fdl | text | permission is granted to copy distribute and or modify this document | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
mpl-2.0 | text | this source code form is subject to the terms | this source code form is subject to the terms of the mozilla public license v(?:ersion)? 2 0
mpl-1.1 | text | the contents of this file are subject to the mozilla public license | the contents of this file are subject to the mozilla public license version 1 1
npl | text | netscape public license | the contents of this file are subject to the netscape public license
epl | text | accompanying program is provided under the terms of this eclipse | the accompanying program is provided under the terms of this eclipse public license
epl | text | accompanying materials are made available under | this program and the accompanying materials are made available under the terms of the eclipse public license
cpl-1.0 | text | accompanying program is provided under the terms of this common | the accompanying program is provided under the terms of this common public license
ipl-1.0 | text | accompanying program is provided under the terms of this ibm | the accompanying program is provided under the terms of this ibm public license
cddl | text | the contents of this file are subject to the terms of the common development | the contents of this file are subject to the terms of the common development and distribution license
zlib | text | in no event will the authors be held liable | in no event will the authors be held liable for any damages arising from the use of this software
zlib | text | the origin of this software must not be misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
libpng | text | the origin of this source code must not be misrepresented | the origin of this source code must not be misrepresented
unlicense | text | free and unencumbered software released into the public domain | this is free and unencumbered software released into the public domain
cc0-1.0 | text | waived all copyright and related | waived all copyright and related or neighbou?ring rights
wtfpl | text | do what the fuck you want | do what the fuck you want to public license
beerware | text | you can buy me a beer | if we meet some day and you think this stuff is worth it you can buy me a beer in return
json | text | shall be used for good not evil | the software shall be used for good not evil
artistic | text | the intent of this document | the intent of this document is to state the conditions under which a package may be copied
artistic-2.0 | text | this license establishes the terms | this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed
postgresql | text | without a written agreement is hereby granted | without fee and without a written agreement is hereby granted
python-2.0 | text | psf hereby grants licensee | psf hereby grants licensee a nonexclusive royalty free world wide license
openssl | text | openssl project | this product includes software developed by the openssl project for use in the openssl toolkit
openssl | text | cryptographic software written by | this product includes cryptographic software written by eric young
ofl-1.1 | text | this font software is licensed under the sil | this font software is licensed under the sil open font license
ofl-1.1 | text | reserved font name | with reserved font names?
ms-pl | text | this license governs use of the accompanying software | this license governs use of the accompanying software if you use the software you accept this license
ms-rl | text | reciprocal grants for any file you distribute | reciprocal grants for any file you distribute that contains code from the software
sspl-1.0 | text | server side public license version 1 | server side public license version 1 october 16 2018
busl-1.1 | text | make non production use | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
elastic-2.0 | text | hosted or managed service | you may not provide the software to third parties as a hosted or managed service
commons-clause | text | the right to sell the software | the grant of rights under the license will not include and the license does not grant to you the right to sell the software
cc-by | text | you are free to share | you are free to share(?: [a-z0-9]+){1,20} under the following terms attribution
cc-by | text | you must give appropriate credit | you must give appropriate credit provide a link to the license and indicate if changes were made
cc-by-nc | text | you may not use the material for commercial purposes | you may not use the material for commercial purposes
cc-by-sa | text | you must distribute your contributions under the same license | you must distribute your contributions under the same license as the original
cc-by-nd | text | you may not distribute the modified material | you may not distribute the modified material
odbl-1.0 | text | database is made available under | this(?: [a-z0-9]+){1,6} database is made available under the open database license
eupl | text | licensed under the eupl | licensed under the eupl(?: version)?(?: 1 [012])?
fdl | text | invariant sections | with no invariant sections no front cover texts and no back cover texts

# notices in which an author grants a license
gpl-3.0 | notice | gnu general public license | gnu general public license(?: as published by the free software foundation)?(?: either)?(?: v| version )(?:3|three)(?: 0)?(?! or| of the license or)
gpl-3.0-or-later | notice | gnu general public license | gnu general public license(?: as published by the free software foundation)?(?: either)?(?: v| version )(?:3|three)(?: 0)?(?: of the license)? or (?:at your option )?any later
gpl-2.0 | notice | gnu general public license | gnu general public license(?: as published by the free software foundation)?(?: either)?(?: v| version )(?:2|two)(?: 0)?(?! or| of the license or)
gpl-2.0-or-later | notice | gnu general public license | gnu general public license(?: as published by the free software foundation)?(?: either)?(?: v| version )(?:2|two)(?: 0)?(?: of the license)? or (?:at your option )?any later
gpl-1.0 | notice | gnu general public license | gnu general public license(?: v| version )1(?: 0)?
gpl | notice | under the gpl | (?:released|distributed|licensed|available|published)(?: [a-z0-9]+){0,3} under the gpl
gpl-2.0 | notice | gpl | (?:released|distributed|licensed|available|published)(?: [a-z0-9]+){0,3} under(?: the)? (?:gnu )?gpl ?v?2(?: 0)?
gpl-3.0 | notice | gpl | (?:released|distributed|licensed|available|published)(?: [a-z0-9]+){0,3} under(?: the)? (?:gnu )?gpl ?v?3(?: 0)?
lgpl-2.1 | notice | lesser general public license | gnu lesser general public license(?: v| version )2 1
lgpl-3.0 | notice | lesser general public license | gnu lesser general public license(?: v| version )3(?: 0)?
lgpl-2.0 | notice | library general public license | gnu library general public license(?: v| version )2(?: 0)?
agpl-3.0 | notice | affero general public license | gnu affero general public license(?: v| version )3(?: 0)?
apache-2.0 | notice | apache license | (?:released|distributed|licensed|available|published)(?: [a-z0-9]+){0,3} under the (?:terms of the )?apache license(?: version)? 2(?: 0)?
apache-2.0 | notice | apache 2 0 | (?:released|distributed|licensed|available|published)(?: [a-z0-9]+){0,3} under(?: the)? apache 2 0(?: license)?
apache | notice | apache license | under the (?:terms of the )?apache license
mit | notice | mit license | (?:released|distributed|licensed|available|published)(?: [a-z0-9]+){0,3} under the (?:terms of the )?mit license
mit | notice | mit | under the (?:terms of the )?mit(?: open source)? (?:licence|style license|expat license)
mit | notice | license mit | license mit(?! [a-z])
bsd | notice | bsd | under (?:the|a) (?:terms of the )?(?:new |modified |simplified |revised )?bsd(?: style)? licen[sc]e
bsd-3-clause | notice | bsd | under (?:the|a) (?:terms of the )?(?:3 clause bsd|bsd 3 clause) licen[sc]e
bsd-2-clause | notice | bsd | under (?:the|a) (?:terms of the )?(?:2 clause bsd|bsd 2 clause) licen[sc]e
mpl-2.0 | notice | mozilla public license | under the (?:terms of the )?mozilla public license(?: v| version )2(?: 0)?
epl-2.0 | notice | eclipse public license | under the (?:terms of the )?eclipse public license(?: v| version )2(?: 0)?
epl-1.0 | notice | eclipse public license | under the (?:terms of the )?eclipse public license(?: v| version )1(?: 0)?
isc | notice | isc licen | under the (?:terms of the )?isc licen[sc]e
zlib | notice | zlib | under the (?:terms of the )?zlib(?: libpng)? licen[sc]e
artistic | notice | artistic license | under the (?:terms of the )?(?:perl )?artistic license
perl | notice | same terms as perl | under the same terms as perl(?: itself)?
ruby | notice | same terms as ruby | under the same terms as ruby(?: itself)?
cc-by-nc-nd | notice | cc by nc nd | (?:licensed|released|available|shared|published)(?: [a-z0-9]+){0,2} under(?: a)? cc by nc nd(?: [1234] [05])?
cc-by-nc-sa | notice | cc by nc sa | (?:licensed|released|available|shared|published)(?: [a-z0-9]+){0,2} under(?: a)? cc by nc sa(?: [1234] [05])?
cc-by-nc | notice | cc by nc | (?:licensed|released|available|shared|published)(?: [a-z0-9]+){0,2} under(?: a)? cc by nc(?: [1234] [05])?
cc-by-nd | notice | cc by nd | (?:licensed|released|available|shared|published)(?: [a-z0-9]+){0,2} under(?: a)? cc by nd(?: [1234] [05])?
cc-by-sa | notice | cc by sa | (?:licensed|released|available|shared|published)(?: [a-z0-9]+){0,2} under(?: a)? cc by sa(?: [1234] [05])?
cc-by | notice | cc by | (?:licensed|released|available|shared|published)(?: [a-z0-9]+){0,2} under(?: a)? cc by(?: [1234] [05])?
cc-by-nc-nd | notice | attribution non | creative commons attribution non ?commercial no ?deriv(?:ative|ative works|s|atives)
cc-by-nc-sa | notice | attribution non | creative commons attribution non ?commercial share ?alike
cc-by-nc | notice | attribution non | creative commons attribution non ?commercial
cc-by-nd | notice | attribution no | creative commons attribution no ?deriv(?:ative|ative works|s|atives)
cc-by-sa | notice | attribution share | creative commons attribution share ?alike
cc-by-nd | notice | cc by nd | work(?: [a-z0-9]+){0,3} cc by nd
cc-by-4.0 | notice | creative commons attribution | creative commons attribution 4 0(?: international)?
cc-by-3.0 | notice | creative commons attribution | creative commons attribution 3 0(?: unported)?
cc-by | notice | creative commons attribution | creative commons attribution(?: generic| international)?(?: license)?
cc0-1.0 | notice | public domain dedication | cc0(?: 1 0)?(?: universal)? public domain dedication
public-domain | notice | public domain | (?:released|placed|dedicated|put|given)(?: [a-z0-9]+){0,3} (?:in|into|to) the public domain
public-domain | notice | public domain | (?:this|the) (?:work|file|software|code|text|document|image) is in the public domain
all-rights-reserved | notice | all rights reserved | copyright(?: c)? [0-9]{4}(?: [a-z0-9]+){1,8} all rights reserved
proprietary | notice | confidential | (?:proprietary and confidential|confidential and proprietary)
proprietary | notice | copying of this file | unauthori[sz]ed copying of this file via any medium is strictly prohibited
proprietary | notice | may not be reproduced | may not be reproduced(?: [a-z0-9]+){0,6} without (?:the )?(?:prior )?(?:express )?written (?:permission|consent)
proprietary | notice | subject to the terms of your license agreement | use of this software is subject to the terms of your license agreement
ogl-3.0 | notice | open government licen | licensed under the open government licen[cs]e(?: v3 0| v 3 0| version 3)?
ogl-uk | notice | contains public sector information | contains public sector information licensed under the open government licen[cs]e
etalab | notice | licence ouverte | licence ouverte(?: open licence)?(?: version)?(?: 2 0)?
dl-de-by | notice | datenlizenz deutschland | datenlizenz deutschland namensnennung(?: version)?(?: 2 0)?
dl-de-zero | notice | datenlizenz deutschland | datenlizenz deutschland zero(?: version)?(?: 2 0)?
gpl | notice | general public license | (?:unter|bajo|sous|sotto)(?: [a-z0-9]+){0,3} gnu general public license
cc-by | notice | creative commons | (?:lizenz creative commons|licence creative commons|licencia creative commons|licenza creative commons) (?:namensnennung|attribution|reconocimiento|atribucion|attribuzione)

# names of licenses
apache-2.0 | name | apache license | apache license(?: version| v)? ?2(?: 0)?
apache-1.1 | name | apache license | apache license(?: version| v)? ?1 1
apache-1.0 | name | apache license | apache license(?: version| v)? ?1 0
apache-2.0 | name | apache | apache (?:software license|public license|licence)(?: version| v)? ?2(?: 0)?
apache | name | apache software license | apache software license
apache-2.0 | name | asl 2 0 | asl 2 0
gpl-2.0 | name | gpl | (?:gnu )?gpl ?(?:v|version )?2(?: 0)?(?! 1)
gpl-3.0 | name | gpl | (?:gnu )?gpl ?(?:v|version )?3(?: 0)?
gpl | name | gnu gpl | gnu gpl
gpl | name | gnu public licen | gnu public licen[sc]e
lgpl | name | lgpl | (?:gnu )?lgpl(?: ?(?:v|version )?[23](?: [01])?)?
lgpl | name | general public licen | gnu (?:lesser|library) general public licen[sc]e
agpl | name | affero | (?:gnu )?affero (?:gpl|general public licen[sc]e)
agpl | name | agpl | (?:gnu )?agpl(?: ?(?:v|version )?3(?: 0)?)?
fdl | name | free documentation licen | gnu free documentation licen[sc]e(?:(?: version| v)? 1 [123])?
fdl | name | gfdl | gfdl(?: 1 [123])?
mpl-2.0 | name | mozilla public licen | mozilla public licen[sc]e(?: version| v)? ?2(?: 0)?
mpl-1.1 | name | mozilla public licen | mozilla public licen[sc]e(?: version| v)? ?1 1
mpl | name | mozilla public licen | mozilla public licen[sc]e
epl | name | eclipse public licen | eclipse public licen[sc]e
edl-1.0 | name | eclipse distribution licen | eclipse distribution licen[sc]e(?: v 1 0| 1 0)?
cddl | name | common development and distribution licen | common development and distribution licen[sc]e
cpl-1.0 | name | common public licen | common public licen[sc]e(?: version| v)?(?: 1 0)?
cpal-1.0 | name | common public attribution licen | common public attribution licen[sc]e
ipl-1.0 | name | ibm public licen | ibm public licen[sc]e
eupl | name | european union public licen | european union public licen[sc]e
cecill | name | cecill | cecill(?: b| c)?(?: 2 [01])?
mit-0 | name | mit no attribution | mit no attribution(?: license)?
mit | name | mit licen | (?:expat |x11 )?mit licen[sc]e
mit | name | expat licen | expat licen[sc]e
x11 | name | x11 licen | x11 licen[sc]e
isc | name | isc licen | isc licen[sc]e
bsd-3-clause | name | bsd | (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?
bsd-2-clause | name | bsd | (?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd licen[sc]e)(?: licen[sc]e)?
bsd-4-clause | name | bsd | (?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[sc]e)?
0bsd | name | bsd | (?:zero clause bsd|bsd zero clause|0bsd)(?: licen[sc]e)?
bsd | name | bsd licen | bsd licen[sc]e
bsl-1.0 | name | boost software licen | boost software licen[sc]e(?: version)?(?: 1 0)?
zlib | name | zlib | zlib(?: libpng)? licen[sc]e
libpng | name | libpng licen | libpng licen[sc]e
unlicense | name | the unlicense | the unlicense
wtfpl | name | wtfpl | wtfpl
beerware | name | beer | beer ?ware licen[sc]e
artistic-2.0 | name | artistic licen | artistic licen[sc]e 2(?: 0)?
artistic | name | artistic licen | artistic licen[sc]e
postgresql | name | postgresql licen | postgresql licen[sc]e
python-2.0 | name | python software foundation licen | python software foundation licen[sc]e
psf | name | psf licen | psf licen[sc]e
php-3.01 | name | php licen | php licen[sc]e(?:(?: version| v)? 3 01?)?
ruby | name | ruby licen | ruby licen[sc]e
openssl | name | openssl licen | openssl licen[sc]e
ncsa | name | university of illinois | university of illinois(?: ncsa)? open source licen[sc]e
upl-1.0 | name | universal permissive licen | universal permissive licen[sc]e
afl | name | academic free licen | academic free licen[sc]e
osl | name | open software licen | open software licen[sc]e
ecl-2.0 | name | educational community licen | educational community licen[sc]e
ms-pl | name | microsoft public licen | microsoft public licen[sc]e
ms-rl | name | microsoft reciprocal licen | microsoft reciprocal licen[sc]e
ofl-1.1 | name | open font licen | (?:sil )?open font licen[sc]e(?: version)?(?: 1 1)?
lppl | name | latex project public licen | latex project public licen[sc]e
vim | name | vim licen | vim licen[sc]e
w3c | name | w3c software | w3c software(?: notice)?(?: and)? (?:document )?licen[sc]e
json | name | json licen | json licen[sc]e
sspl-1.0 | name | server side public licen | server side public licen[sc]e
busl-1.1 | name | business source licen | business source licen[sc]e(?: 1 1)?
elastic-2.0 | name | elastic licen | elastic licen[sc]e(?: 2 0| v2)?
confluent | name | confluent community licen | confluent community licen[sc]e
commons-clause | name | commons clause | commons clause
polyform-nc | name | polyform | polyform noncommercial licen[sc]e
polyform-sb | name | polyform | polyform small business licen[sc]e
parity | name | parity public licen | parity public licen[sc]e
blueoak | name | blue oak model licen | blue oak model licen[sc]e
openrail | name | openrail | (?:creativeml |bigscience |bigcode )?openrail(?: m)?(?: licen[sc]e)?
rail | name | responsible ai licen | responsible ai licen[sc]es?
cc-by-nc-nd | name | cc by nc nd | cc by nc nd(?: [1234] [05])?
cc-by-nc-sa | name | cc by nc sa | cc by nc sa(?: [1234] [05])?
cc-by-nc-4.0 | name | cc by nc | cc by nc 4 0
cc-by-nc-3.0 | name | cc by nc | cc by nc 3 0
cc-by-nc | name | cc by nc | cc by nc
cc-by-nd | name | cc by nd | cc by nd(?: [1234] [05])?
cc-by-sa-4.0 | name | cc by sa | cc by sa 4 0
cc-by-sa-3.0 | name | cc by sa | cc by sa 3 0
cc-by-sa | name | cc by sa | cc by sa
cc-by-4.0 | name | cc by | cc by 4 0
cc-by-3.0 | name | cc by | cc by 3 0
cc-by-2.5 | name | cc by | cc by 2 5
cc-by-2.0 | name | cc by | cc by 2 0
cc0-1.0 | name | cc0 | cc0(?: 1 0)?(?: universal)?
cc-zero | name | creative commons zero | creative commons zero(?: license)?
odbl-1.0 | name | open database licen | open database licen[sc]e
odc-by-1.0 | name | open data commons attribution | open data commons attribution licen[sc]e
pddl-1.0 | name | public domain dedication and licen | public domain dedication and licen[sc]e
cdla | name | community data licen | community data licen[sc]e agreement(?: permissive| sharing)?
ogl | name | open government licen | open government licen[sc]e
etalab | name | etalab | etalab(?: open)? licen[sc]e

# words that only hint at a license
copyleft | hint | copyleft | copyleft
open-source | hint | open source licen | open source licen[sc]es?
creative-commons | hint | creative commons | creative commons(?: licen[sc]es?)?
free-software | hint | free software licen | free software licen[sc]es?
public-domain | hint | public domain | public domain
all-rights-reserved | hint | all rights reserved | all rights reserved
dual-license | hint | dual licen | dual licen[sc]ed?
eula | hint | end user licen | end user licen[sc]e agreement
license-file | hint | file for | see(?: the)? licen[sc]e(?: txt| md)? file for (?:more )?(?:details|information|the full license text)
"""

#: The phrases that every scan reports, wherever their words stand side by side. Fixed values.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Kinds in order of priority, and how sure a detection of the kind is.
KINDS = {"spdx": 0.99, "url": 0.95, "text": 0.95, "notice": 0.9, "name": 0.7, "base": 0.5, "hint": 0.2}
