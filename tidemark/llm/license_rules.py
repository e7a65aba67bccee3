"""Signature rules of licences: label | keyword | pattern, in order of priority.

Fixed values, written by hand: names and phrases of public licences as they read once a text is cut
to lower-case words with one blank between. The keyword is in every match of its pattern. ``VER`` in
a pattern stands for the ways of writing "version". Rules for SPDX tags follow from the labels.
"""

VER = r"(?:,? ?(?:v|ver|version))? ?"

NAMES = r"""
agpl-3.0-or-later | affero | (?:gnu )?affero general public license VER3(?: 0)? or (?:\(?at your option\)? )?(?:any )?later(?: version)?
agpl-3.0 | affero | (?:gnu )?affero general public license VER3(?: 0)?
agpl-3.0 | agpl | agpl ?VER3(?: 0)?
agpl-1.0 | affero | affero general public license VER1(?: 0)?
agpl | affero | (?:gnu )?affero (?:general public )?license
lgpl-3.0-or-later | lesser | (?:gnu )?lesser general public license VER3(?: 0)? or (?:at your option )?any later version
lgpl-3.0 | lesser | (?:gnu )?lesser general public license VER3(?: 0)?
lgpl-3.0 | lgpl | lgpl ?VER3(?: 0)?
lgpl-2.1-or-later | lesser | (?:gnu )?lesser general public license VER2 1 or (?:at your option )?any later version
lgpl-2.1 | lesser | (?:gnu )?lesser general public license VER2 1
lgpl-2.1 | lgpl | lgpl ?VER2 1
lgpl-2.0 | library general | (?:gnu )?library general public license VER2(?: 0)?
lgpl-2.0 | lgpl | lgpl ?VER2(?: 0)?
lgpl | lesser general | (?:gnu )?lesser general public license
lgpl | library general | (?:gnu )?library general public license
gpl-3.0-or-later | general public | (?:gnu )?general public license VER3(?: 0)? or (?:at your option )?any later version
gpl-3.0-or-later | gpl | gpl ?VER3(?: 0)? or later
gpl-3.0 | general public | (?:gnu )?general public license VER3(?: 0)?
gpl-3.0 | general public | version 3(?: 0)? of the (?:gnu )?general public license
gpl-3.0 | gpl | gpl ?VER3(?: 0)?
gpl-2.0-or-later | general public | (?:gnu )?general public license VER2(?: 0)? or (?:at your option )?any later version
gpl-2.0-or-later | gpl | gpl ?VER2(?: 0)? or later
gpl-2.0-classpath | classpath | general public license VER2(?: 0)? with (?:the )?classpath exception
gpl-2.0 | general public | (?:gnu )?general public license VER2(?: 0)?
gpl-2.0 | general public | version 2(?: 0)? of the (?:gnu )?general public license
gpl-2.0 | gpl | gpl ?VER2(?: 0)?
gpl-1.0 | general public | (?:gnu )?general public license VER1(?: 0)?
gpl | gpl | (?:gnu )?gpl
gfdl-1.3 | free documentation | (?:gnu )?free documentation license VER1 3
gfdl-1.2 | free documentation | (?:gnu )?free documentation license VER1 2
gfdl-1.1 | free documentation | (?:gnu )?free documentation license VER1 1
gfdl | free documentation | (?:gnu )?free documentation license
apache-2.0 | apache | apache (?:software )?license VER2(?: 0)?
apache-2.0 | apache | apache ?VER2 0(?: license)?
apache-2.0 | apache org licenses license 2 0 | (?:www )?apache org licenses license 2 0
apache-1.1 | apache | apache (?:software )?license VER1 1
apache-1.0 | apache | apache (?:software )?license VER1 0
apache | apache | apache (?:software )?licen[sc]ed?
mit-0 | mit no attribution | mit no attribution(?: license)?
mit-modern | mit license modern variant | mit license modern variant
mit | mit licen | (?:the )?mit licen[sc]ed?
mit | mit style | mit style licen[sc]e
mit | expat licen | expat licen[sc]e
mit | permission is hereby granted free of charge to any person obtaining a copy | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | the above copyright notice and this permission notice shall be included | the above copyright notice and this permission notice shall be included in all copies or substantial portions
bsd-4-clause | bsd | (?:4|four) clause bsd(?: license)?
bsd-4-clause | bsd | bsd 4 clause(?: license)?
bsd-3-clause-clear | clear bsd | (?:3 clause )?clear bsd(?: license)?
bsd-3-clause | bsd | (?:3|three) clause bsd(?: license)?
bsd-3-clause | bsd | bsd 3 clause(?: license)?
bsd-3-clause | new bsd | (?:the )?new bsd licen[sc]e
bsd-3-clause | modified bsd | (?:the )?modified bsd licen[sc]e
bsd-3-clause | may be used to endorse or promote products derived | neither the name of .{1,120} may be used to endorse or promote products derived
bsd-2-clause-patent | plus patent | bsd 2 clause plus patent(?: license)?
bsd-2-clause | bsd | (?:2|two) clause bsd(?: license)?
bsd-2-clause | bsd | bsd 2 clause(?: license)?
bsd-2-clause | simplified bsd | simplified bsd licen[sc]e
bsd-2-clause | freebsd licen | freebsd licen[sc]e
0bsd | zero clause bsd | (?:bsd )?zero clause bsd(?: license)?
0bsd | 0bsd | 0bsd
bsd | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted
bsd | bsd licen | (?:the )?bsd licen[sc]ed?
bsd | bsd style | bsd style licen[sc]e
mpl-2.0-no-copyleft | incompatible with secondary licenses | incompatible with secondary licenses as defined by the mozilla public license
mpl-2.0 | mozilla public | mozilla public license VER2(?: 0)?
mpl-2.0 | mpl | mpl ?VER2(?: 0)?
mpl-1.1 | mozilla public | mozilla public license VER1 1
mpl-1.1 | mpl | mpl ?VER1 1
mpl-1.0 | mozilla public | mozilla public license VER1 0
mpl | mozilla public | mozilla public license
epl-2.0 | eclipse public | eclipse public license VER2(?: 0)?
epl-1.0 | eclipse public | eclipse public license VER1(?: 0)?
epl | eclipse public | eclipse public license
edl-1.0 | eclipse distribution | eclipse distribution license VER1(?: 0)?
cddl-1.1 | common development and distribution | common development and distribution license VER1 1
cddl-1.0 | common development and distribution | common development and distribution license(?: VER1(?: 0)?)?
cddl-1.0 | cddl | cddl(?: VER1(?: 0)?)?
cpl-1.0 | common public license | common public license(?: VER1(?: 0)?)?
cpal-1.0 | common public attribution | common public attribution license(?: VER1(?: 0)?)?
eupl-1.2 | european union public | european union public licen[sc]e VER1 2
eupl-1.1 | european union public | european union public licen[sc]e VER1 1
eupl-1.2 | eupl | eupl ?VER1 2
eupl | european union public | european union public licen[sc]e
osl-3.0 | open software license | open software license VER3(?: 0)?
osl-2.1 | open software license | open software license VER2 1
afl-3.0 | academic free | academic free license VER3(?: 0)?
afl | academic free | academic free license
artistic-2.0 | artistic license | (?:the )?artistic license VER2(?: 0)?
artistic-1.0 | artistic license | (?:the )?artistic license VER1(?: 0)?
artistic | artistic license | (?:the )?artistic license
bsl-1.0 | boost software | boost software license(?: VER1(?: 0)?)?
isc | isc licen | (?:the )?isc licen[sc]e
isc | permission to use copy modify and | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
zlib | zlib | zlib(?: libpng)? licen[sc]e
libpng | libpng licen | libpng licen[sc]e
unlicense | this is free and unencumbered software | this is free and unencumbered software released into the public domain
unlicense | the unlicense | (?:under )?the unlicense
wtfpl | do what the fuck you want to | do what the fuck you want to public license
wtfpl | wtfpl | wtfpl
beerware | beer ware | beer ware license
psf-2.0 | python software foundation | python software foundation license(?: VER2(?: 0)?)?
python-2.0 | python license | python license VER2(?: 0)?
php-3.01 | php license | (?:the )?php license VER3 01
php-3.0 | php license | (?:the )?php license VER3 0
php | php license | (?:the )?php license
ruby | ruby license | (?:the )?ruby license
ofl-1.1 | open font | (?:sil )?open font license(?: VER1 1)?
ofl-1.1 | sil ofl | sil ofl(?: VER1 1)?
ipl-1.0 | ibm public | ibm public license(?: VER1(?: 0)?)?
ms-pl | microsoft public | microsoft public license
ms-rl | microsoft reciprocal | microsoft reciprocal license
ncsa | illinois | university of illinois (?:ncsa )?open source license
postgresql | postgresql licen | postgresql licen[sc]e
openssl | openssl licen | openssl licen[sc]e
curl | curl licen | curl licen[sc]e
vim | vim licen | vim licen[sc]e
x11 | x11 licen | x11 licen[sc]e
w3c | w3c software | w3c software (?:notice and )?(?:document )?licen[sc]e
json | the software shall be used for good | the software shall be used for good not evil
upl-1.0 | universal permissive | universal permissive license(?: VER1(?: 0)?)?
mulan-psl-2.0 | mulan | mulan (?:psl|permissive software license) ?VER2
cecill-2.1 | cecill | cecill(?: free software license agreement)? VER2 1
cecill | cecill | cecill
sspl-1.0 | server side public | server side public license(?: VER1)?
busl-1.1 | business source | business source license(?: VER1 1)?
elastic-2.0 | elastic license | elastic license VER2(?: 0)?
polyform-noncommercial | polyform | polyform noncommercial license
polyform | polyform | polyform [a-z ]{1,30}license
commons-clause | commons clause | commons clause(?: license)?(?: condition)?
openrail | rail | (?:creativeml )?open ?rail(?: ?[ms])?(?: license)?
llama-community | llama | llama [0-9 ]{0,5}community license
odbl-1.0 | database license | open (?:data commons )?(?:open )?database license(?: VER1(?: 0)?)?
odc-by-1.0 | open data commons | open data commons attribution license(?: VER1(?: 0)?)?
pddl-1.0 | public domain dedication and license | (?:open data commons )?public domain dedication and license
cdla-permissive-2.0 | community data license | community data license agreement permissive(?: VER2(?: 0)?)?
cdla-sharing-1.0 | community data license | community data license agreement sharing(?: VER1(?: 0)?)?
ogl-3.0 | open government | open government licen[sc]e VER3(?: 0)?
ogl | open government | open government licen[sc]e
etalab-2.0 | etalab | (?:licence ouverte )?etalab VER2(?: 0)?
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | creative commons | creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?
cc0-1.0 | publicdomain zero | creativecommons org publicdomain zero 1 0
cc-pdm-1.0 | public domain mark | public domain mark(?: 1 0)?
cc-by-nc-nd | by nc nd | (?:cc )?by nc nd(?: [1-4] [05])?
cc-by-nc-nd | commercial no | attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?
cc-by-nc-sa | by nc sa | (?:cc )?by nc sa(?: [1-4] [05])?
cc-by-nc-sa | commercial share | attribution non ?commercial share ?alike(?: [1-4] [05])?
cc-by-nc-4.0 | by nc 4 0 | (?:cc )?by nc 4 0
cc-by-nc | cc by nc | cc by nc(?: [1-4] [05])?
cc-by-nc | commercial | attribution non ?commercial(?: [1-4] [05])?
cc-by-nd-4.0 | by nd 4 0 | (?:cc )?by nd 4 0
cc-by-nd | cc by nd | cc by nd(?: [1-4] [05])?
cc-by-nd | attribution no | attribution no ?deriv(?:ative)?s(?: [1-4] [05])?
cc-by-sa-4.0 | by sa 4 0 | (?:cc )?by sa 4 0
cc-by-sa-3.0 | by sa 3 0 | (?:cc )?by sa 3 0
cc-by-sa | cc by sa | cc by sa(?: [1-4] [05])?
cc-by-sa | attribution share | attribution share ?alike(?: [1-4] [05])?
cc-by-4.0 | cc by 4 0 | cc by 4 0
cc-by-4.0 | attribution 4 0 | attribution 4 0 international
cc-by-3.0 | cc by 3 0 | cc by 3 0
cc-by-2.0 | cc by 2 0 | cc by 2 0
cc | licensed under a creative commons | licensed under a creative commons
cc | creative commons | creative commons (?:public )?licen[sc]e
public-domain | public domain | (?:released|placed|dedicated|put) (?:in|into|to) the public domain
public-domain | public domain | (?:this work|this file|it) is in the public domain
proprietary | proprietary and confidential | proprietary and confidential
proprietary | unauthorized copying | unauthorized copying (?:of|or distribution)
no-copying | no part of this | no part of this (?:publication|book|work|document) may be reproduced
no-copying | may not be reproduced | may not be reproduced (?:or distributed )?without (?:prior |express |the )?(?:written )?permission
permission | reproduced with | reproduced with (?:the )?(?:kind )?permission of
permission | reprinted | reprinted (?:with|by) permission
copyright | copyright | copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?
cern-ohl-s-2.0 | cern open hardware licen | cern open hardware licen[sc]e VER2(?: 0)? strongly reciprocal
cern-ohl-w-2.0 | cern open hardware licen | cern open hardware licen[sc]e VER2(?: 0)? weakly reciprocal
cern-ohl-p-2.0 | cern open hardware licen | cern open hardware licen[sc]e VER2(?: 0)? permissive
cern-ohl-1.2 | cern open hardware licen | cern open hardware licen[sc]e VER1 2
tapr-ohl-1.0 | tapr open hardware | tapr open hardware license(?: VER1 0)?
solderpad-0.51 | solderpad hardware | solderpad hardware licen[sc]e(?: VER0 51)?
hippocratic-2.1 | hippocratic | hippocratic license(?: VER2 1)?
sspl-1.0 | server side public | server side public license(?: VER1(?: 0)?)?
commons-clause | commons clause | commons clause(?: license condition VER1 0)?
polyform-noncommercial-1.0 | polyform | polyform noncommercial license(?: VER?1 0 0)?
polyform-small-business-1.0 | polyform | polyform small business license(?: VER?1 0 0)?
prosperity-3.0 | prosperity public | prosperity public license(?: VER?3 0 0)?
parity-7.0 | parity public | parity public license(?: VER?7 0 0)?
openrail-m | openrail | (?:creativeml |bigcode )?openrail m(?: license)?
llama-community | llama | llama (?:\d )+?community license(?: agreement)?
gemma | gemma terms | gemma terms of use
cdla-permissive-2.0 | community data license agreement | community data license agreement permissive VER2(?: 0)?
cdla-permissive-1.0 | community data license agreement | community data license agreement permissive VER1(?: 0)?
cdla-sharing-1.0 | community data license agreement | community data license agreement sharing VER1(?: 0)?
odc-by-1.0 | open data commons attribution | open data commons attribution license(?: VER1 0)?
pddl-1.0 | public domain dedication and license | (?:open data commons )?public domain dedication and license(?: VER1 0)?
dl-de-by-2.0 | datenlizenz deutschland | datenlizenz deutschland (?:namensnennung )?VER2 0
etalab-2.0 | licence ouverte | licence ouverte(?: open licence)?(?: VER2 0)?
ogl-uk-3.0 | open government licen | open government licen[sc]e VER3 0
ogl-uk | open government licen | open government licen[sc]e
ofl-1.1 | sil open font | sil open font license VER1 1
ofl | open font license | (?:sil )?open font license
ubuntu-font-1.0 | ubuntu font | ubuntu font licen[sc]e(?: VER1 0)?
bitstream-vera | bitstream vera | bitstream vera fonts copyright
blueoak-1.0.0 | blue oak model | blue oak model license(?: 1 0 0)?
mulan-psl-2.0 | mulan permissive | mulan permissive software license VER2
cecill-2.1 | cecill | (?:free software license agreement )?cecill VER2 1
cecill-b | cecill b | cecill b(?: free software license agreement)?
upl-1.0 | universal permissive | universal permissive license(?: VER1 0)?
zlib | this software is provided as is without any express or implied warranty | this software is provided as is without any express or implied warranty in no event will the authors
isc | permission to use copy modify and or distribute this software | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
"""
