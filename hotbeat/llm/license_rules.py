"""Signature rules of the licence scan, one a line: priority, label, keyword, expression.

Expressions run over normalised text: words in lower case with one blank between them.  Every match
contains the keyword.  Priority 4 is wording of the licence or its notice, 3 an identifier, 2 a
named licence with its version or a grant, 1 a bare name.
"""

from __future__ import annotations

RULES_TEXT = r"""
4 mit permission is hereby granted = permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
4 mit the above copyright notice and this permission notice = the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies
3 mit spdx license identifier mit = spdx license identifier mit
2 mit mit license = (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of the )?mit license
2 mit mit licence = (?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of the )?mit licence
2 mit mit license = (?:the )?mit license (?:mit|expat)
2 mit license mit = license mit
2 mit expat licen = (?:the )?expat licen[cs]e
1 mit mit license = (?:the )?mit license
1 mit mit licence = (?:the )?mit licence
2 mit-0 mit no attribution = mit no attribution(?: licen[cs]e)?
3 mit-0 spdx license identifier mit 0 = spdx license identifier mit 0
3 apache-2 spdx license identifier apache 2 = spdx license identifier apache 2 0
4 apache-2 you may not use this file except in compliance = licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
4 apache-2 you may obtain a copy of the license = you may obtain a copy of the license at (?:http|https) www apache org licenses license 2 0
2 apache-2 apache license version 2 = (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of the )?apache license version 2(?: 0)?
2 apache-2 apache license version 2 = (?:the )?apache license version 2(?: 0)?
2 apache-2 apache 2 0 = (?:the )?apache 2 0(?: licen[cs]e)?
2 apache-2 apache license 2 = (?:the )?apache license 2(?: 0)?
2 apache-2 apache software license 2 = (?:the )?apache software license 2(?: 0)?
2 apache-2 apache software license version 2 = (?:the )?apache software license version 2(?: 0)?
2 apache-1.1 apache software license version 1 1 = (?:the )?apache software license version 1 1
3 apache-1.1 spdx license identifier apache 1 1 = spdx license identifier apache 1 1
2 apache-1.0 apache software license version 1 0 = (?:the )?apache software license version 1 0
1 apache apache license = (?:the )?apache license
1 apache apache software license = (?:the )?apache software license
1 apache apache licence = (?:the )?apache licence
4 gpl-3 either version 3 of the license = under the terms of the gnu general public license as published by the free software foundation either version 3 of the license
4 gpl-2 either version 2 of the license = under the terms of the gnu general public license as published by the free software foundation either version 2 of the license
3 gpl-3 spdx license identifier gpl 3 = spdx license identifier gpl 3 0(?: only| or later)?
3 gpl-2 spdx license identifier gpl 2 = spdx license identifier gpl 2 0(?: only| or later)?
3 gpl-1 spdx license identifier gpl 1 = spdx license identifier gpl 1 0(?: only| or later)?
2 gpl-3 gnu general public license version 3 = (?:(?:licensed|released|distributed) under )?(?:the )?gnu general public license version 3(?: 0)?(?: or (?:any )?later(?: version)?)?
2 gpl-2 gnu general public license version 2 = (?:(?:licensed|released|distributed) under )?(?:the )?gnu general public license version 2(?: 0)?(?: or (?:any )?later(?: version)?)?
2 gpl-3 gnu general public license v3 = (?:the )?gnu general public license v3(?: 0)?
2 gpl-2 gnu general public license v2 = (?:the )?gnu general public license v2(?: 0)?
2 gpl-3 gnu gpl = (?:the )?gnu gpl (?:version |v )?(?:3|v3)(?: 0)?
2 gpl-2 gnu gpl = (?:the )?gnu gpl (?:version |v )?(?:2|v2)(?: 0)?
2 gpl-3 gplv3 = (?:the )?(?:gnu )?gplv3
2 gpl-2 gplv2 = (?:the )?(?:gnu )?gplv2
2 gpl-3 gpl 3 0 = (?:the )?gpl 3 0(?: licen[cs]e)?
2 gpl-2 gpl 2 0 = (?:the )?gpl 2 0(?: licen[cs]e)?
1 gpl gnu general public licen = (?:the )?gnu general public licen[cs]e
1 gpl gnu gpl = (?:the )?gnu gpl
1 gpl gpl licen = (?:the )?gpl licen[cs]ed?
4 lgpl-3 lesser general public license = under the terms of the gnu lesser general public license as published by the free software foundation either version 3
4 lgpl-2.1 lesser general public license = under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1
3 lgpl-3 spdx license identifier lgpl 3 = spdx license identifier lgpl 3 0(?: only| or later)?
3 lgpl-2.1 spdx license identifier lgpl 2 1 = spdx license identifier lgpl 2 1(?: only| or later)?
3 lgpl-2 spdx license identifier lgpl 2 0 = spdx license identifier lgpl 2 0(?: only| or later)?
2 lgpl-3 lesser general public license version 3 = (?:the )?(?:gnu )?lesser general public license version 3(?: 0)?
2 lgpl-2.1 lesser general public license version 2 1 = (?:the )?(?:gnu )?lesser general public license version 2 1
2 lgpl-2 library general public license version 2 = (?:the )?(?:gnu )?library general public license version 2(?: 0)?
2 lgpl-3 lgplv3 = (?:the )?(?:gnu )?lgplv3
2 lgpl-2.1 lgplv2 1 = (?:the )?(?:gnu )?lgplv2 1
2 lgpl-2.1 lgpl 2 1 = (?:the )?(?:gnu )?lgpl 2 1
2 lgpl-3 lgpl 3 = (?:the )?(?:gnu )?lgpl 3(?: 0)?
1 lgpl lesser general public licen = (?:the )?(?:gnu )?lesser general public licen[cs]e
1 lgpl library general public licen = (?:the )?(?:gnu )?library general public licen[cs]e
1 lgpl lgpl licen = (?:the )?lgpl licen[cs]ed?
4 agpl-3 affero general public license = under the terms of the gnu affero general public license as published by the free software foundation either version 3
3 agpl-3 spdx license identifier agpl 3 = spdx license identifier agpl 3 0(?: only| or later)?
2 agpl-3 affero general public license version 3 = (?:the )?(?:gnu )?affero general public license version 3(?: 0)?
2 agpl-3 agplv3 = (?:the )?(?:gnu )?agplv3
2 agpl-3 agpl 3 = (?:the )?(?:gnu )?agpl 3(?: 0)?
1 agpl affero general public licen = (?:the )?(?:gnu )?affero general public licen[cs]e
1 agpl agpl licen = (?:the )?agpl licen[cs]ed?
2 gfdl-1.3 free documentation license version 1 3 = (?:the )?(?:gnu )?free documentation license version 1 3
2 gfdl-1.2 free documentation license version 1 2 = (?:the )?(?:gnu )?free documentation license version 1 2
2 gfdl-1.1 free documentation license version 1 1 = (?:the )?(?:gnu )?free documentation license version 1 1
1 gfdl free documentation licen = (?:the )?(?:gnu )?free documentation licen[cs]e
3 gfdl-1.3 spdx license identifier gfdl 1 3 = spdx license identifier gfdl 1 3(?: only| or later)?
4 bsd redistribution and use in source and binary forms = redistribution and use in source and binary forms with or without modification are permitted
4 bsd-3 neither the name of = neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products derived from this software
4 bsd-4 all advertising materials mentioning features = all advertising materials mentioning features or use of this software must display the following acknowledge?ment
3 bsd-2 spdx license identifier bsd 2 clause = spdx license identifier bsd 2 clause
3 bsd-3 spdx license identifier bsd 3 clause = spdx license identifier bsd 3 clause
3 0bsd spdx license identifier 0bsd = spdx license identifier 0bsd
2 bsd-2 bsd 2 clause = (?:the )?bsd 2 clause(?: licen[cs]e)?
2 bsd-3 bsd 3 clause = (?:the )?bsd 3 clause(?: licen[cs]e)?
2 bsd-4 bsd 4 clause = (?:the )?bsd 4 clause(?: licen[cs]e)?
2 bsd-2 2 clause bsd = (?:the )?2 clause bsd(?: licen[cs]e)?
2 bsd-3 3 clause bsd = (?:the )?3 clause bsd(?: licen[cs]e)?
2 bsd-2 simplified bsd licen = (?:the )?simplified bsd licen[cs]e
2 bsd-2 freebsd licen = (?:the )?freebsd licen[cs]e
2 bsd-3 new bsd licen = (?:the )?new bsd licen[cs]e
2 bsd-3 modified bsd licen = (?:the )?modified bsd licen[cs]e
2 bsd-3 revised bsd licen = (?:the )?revised bsd licen[cs]e
2 bsd-4 original bsd licen = (?:the )?original bsd licen[cs]e
2 0bsd zero clause bsd = (?:the )?zero clause bsd(?: licen[cs]e)?
1 bsd bsd licen = (?:the )?bsd licen[cs]ed?
1 bsd bsd style licen = (?:a )?bsd style licen[cs]e
4 isc permission to use copy modify and or distribute = permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
3 isc spdx license identifier isc = spdx license identifier isc
1 isc isc licen = (?:the )?isc licen[cs]e
4 mpl-2 mozilla public license = this source code form is subject to the terms of the mozilla public license v 2 0
3 mpl-2 spdx license identifier mpl 2 = spdx license identifier mpl 2 0
3 mpl-1.1 spdx license identifier mpl 1 1 = spdx license identifier mpl 1 1
2 mpl-2 mozilla public license = (?:the )?mozilla public license (?:version |v |v)?2(?: 0)?
2 mpl-1.1 mozilla public license = (?:the )?mozilla public license (?:version |v |v)?1 1
2 mpl-2 mpl 2 0 = (?:the )?mpl 2 0
1 mpl mozilla public licen = (?:the )?mozilla public licen[cs]e
3 epl-2 spdx license identifier epl 2 = spdx license identifier epl 2 0
3 epl-1 spdx license identifier epl 1 = spdx license identifier epl 1 0
2 epl-2 eclipse public license = (?:the )?eclipse public license (?:version |v |v)?2(?: 0)?
2 epl-1 eclipse public license = (?:the )?eclipse public license (?:version |v |v)?1(?: 0)?
1 epl eclipse public licen = (?:the )?eclipse public licen[cs]e
1 edl eclipse distribution licen = (?:the )?eclipse distribution licen[cs]e(?: version| v)?(?: 1 0)?
3 cddl-1.0 spdx license identifier cddl 1 0 = spdx license identifier cddl 1 0
3 cddl-1.1 spdx license identifier cddl 1 1 = spdx license identifier cddl 1 1
2 cddl-1.0 common development and distribution license = (?:the )?common development and distribution license (?:version |v )?1 0
2 cddl-1.1 common development and distribution license = (?:the )?common development and distribution license (?:version |v )?1 1
1 cddl common development and distribution licen = (?:the )?common development and distribution licen[cs]e
1 cpl common public licen = (?:the )?common public licen[cs]e(?: version| v)?(?: 1 0)?
1 ipl ibm public licen = (?:the )?ibm public licen[cs]e(?: version| v)?(?: 1 0)?
3 eupl-1.2 spdx license identifier eupl 1 2 = spdx license identifier eupl 1 2
2 eupl-1.2 european union public licen = (?:the )?european union public licen[cs]e (?:version |v |v)?1 2
2 eupl-1.1 european union public licen = (?:the )?european union public licen[cs]e (?:version |v |v)?1 1
1 eupl european union public licen = (?:the )?european union public licen[cs]e
3 cc0 spdx license identifier cc0 = spdx license identifier cc0 1 0
4 cc0 waived all copyright and related = has waived all copyright and related or neighboring rights
2 cc0 cc0 1 0 = (?:the )?(?:creative commons )?cc0 1 0(?: universal)?
2 cc0 creative commons zero = (?:the )?creative commons zero(?: licen[cs]e| v1 0| 1 0)?
1 cc0 under cc0 = (?:licensed |released |available )?under cc0
3 cc-by spdx license identifier cc by = spdx license identifier cc by [1-4] [05]
3 cc-by-sa spdx license identifier cc by sa = spdx license identifier cc by sa [1-4] [05]
3 cc-by-nc spdx license identifier cc by nc = spdx license identifier cc by nc [1-4] [05]
3 cc-by-nd spdx license identifier cc by nd = spdx license identifier cc by nd [1-4] [05]
3 cc-by-nc-sa spdx license identifier cc by nc sa = spdx license identifier cc by nc sa [1-4] [05]
3 cc-by-nc-nd spdx license identifier cc by nc nd = spdx license identifier cc by nc nd [1-4] [05]
2 cc-by-nc cc by nc = (?:licensed under )?(?:a |the )?(?:creative commons )?cc by nc [1-4] [05]
2 cc-by-sa cc by sa = (?:licensed under )?(?:a |the )?(?:creative commons )?cc by sa [1-4] [05]
2 cc-by-nd cc by nd = (?:licensed under )?(?:a |the )?(?:creative commons )?cc by nd [1-4] [05]
2 cc-by cc by = (?:licensed under )?(?:a |the )?(?:creative commons )?cc by [1-4] [05]
2 cc-by-nc-sa cc by nc sa = (?:licensed under )?(?:a |the )?(?:creative commons )?cc by nc sa(?: [1-4] [05])?
2 cc-by-nc-nd cc by nc nd = (?:licensed under )?(?:a |the )?(?:creative commons )?cc by nc nd(?: [1-4] [05])?
1 cc-by-nc cc by nc = (?:licensed under )?(?:a |the )?cc by nc(?: licen[cs]e)?
1 cc-by-sa cc by sa = (?:licensed under )?(?:a |the )?cc by sa(?: licen[cs]e)?
1 cc-by-nd cc by nd = (?:licensed under )?(?:a |the )?cc by nd(?: licen[cs]e)?
1 cc-by cc by licen = (?:a |the )?cc by licen[cs]e
2 cc-by-nc-sa attribution noncommercial sharealike = (?:creative commons )?attribution noncommercial sharealike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
2 cc-by-nc-nd attribution noncommercial noderiv = (?:creative commons )?attribution noncommercial noderiv(?:s|atives)(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
2 cc-by-nc attribution noncommercial = creative commons attribution noncommercial(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
2 cc-by-nc attribution non commercial = creative commons attribution non commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
2 cc-by-sa attribution sharealike = creative commons attribution sharealike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
2 cc-by-sa attribution share alike = creative commons attribution share alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
2 cc-by-nd attribution noderiv = creative commons attribution noderiv(?:s|atives)(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
1 cc-by creative commons attribution = creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
3 cc-by creativecommons org licenses by = creativecommons org licenses by [1-4] [05]
3 cc-by-sa creativecommons org licenses by sa = creativecommons org licenses by sa [1-4] [05]
3 cc-by-nc creativecommons org licenses by nc = creativecommons org licenses by nc [1-4] [05]
3 cc-by-nd creativecommons org licenses by nd = creativecommons org licenses by nd [1-4] [05]
3 cc-by-nc-sa creativecommons org licenses by nc sa = creativecommons org licenses by nc sa [1-4] [05]
3 cc-by-nc-nd creativecommons org licenses by nc nd = creativecommons org licenses by nc nd [1-4] [05]
3 cc0 creativecommons org publicdomain zero = creativecommons org publicdomain zero 1 0
3 public-domain creativecommons org publicdomain mark = creativecommons org publicdomain mark 1 0
1 cc creative commons licen = (?:a |the )?creative commons licen[cs]e
4 unlicense free and unencumbered software = this is free and unencumbered software released into the public domain
3 unlicense spdx license identifier unlicense = spdx license identifier unlicense
1 unlicense the unlicense = the unlicense
2 public-domain into the public domain = (?:released|placed|dedicated|put) into the public domain
2 public-domain dedicated to the public domain = dedicated to the public domain
1 public-domain in the public domain = in the public domain
4 wtfpl you just do what the = you just do what the fuck you want to
1 wtfpl wtfpl = (?:the )?wtfpl
4 zlib this software is provided as is = this software is provided as is without any express or implied warranty in no event will the authors be held liable
3 zlib spdx license identifier zlib = spdx license identifier zlib
1 zlib zlib licen = (?:the )?zlib licen[cs]e
1 zlib zlib libpng licen = (?:the )?zlib libpng licen[cs]e
1 libpng libpng licen = (?:the )?libpng licen[cs]e
4 bsl-1.0 boost software license = distributed under the boost software license version 1 0
3 bsl-1.0 spdx license identifier bsl 1 0 = spdx license identifier bsl 1 0
1 bsl-1.0 boost software licen = (?:the )?boost software licen[cs]e(?: version| v)?(?: 1 0)?
3 busl-1.1 spdx license identifier busl 1 1 = spdx license identifier busl 1 1
1 busl-1.1 business source licen = (?:the )?business source licen[cs]e(?: version| v)?(?: 1 1)?
3 artistic-2 spdx license identifier artistic 2 = spdx license identifier artistic 2 0
2 artistic-2 artistic license = (?:the )?(?:perl )?artistic license (?:version |v )?2(?: 0)?
1 artistic artistic licen = (?:the )?(?:perl )?artistic licen[cs]e
4 perl same terms as perl = (?:redistribute|modify|distributed) (?:[^ ]+ ){0,8}under the same terms as perl(?: itself)?
3 python-2 spdx license identifier python 2 0 = spdx license identifier python 2 0
1 psf python software foundation licen = (?:the )?python software foundation licen[cs]e(?: version| v)?(?: 2)?
1 psf psf licen = (?:the )?psf licen[cs]e(?: version| v)?(?: 2)?
1 php php licen = (?:the )?php licen[cs]e(?: version| v)?(?: 3 01| 3 0)?
1 ruby ruby licen = (?:the )?ruby licen[cs]e
1 zend zend = (?:the )?zend (?:engine )?licen[cs]e
1 postgresql postgresql licen = (?:the )?postgresql licen[cs]e
1 openssl openssl licen = (?:the )?openssl licen[cs]e
1 ssleay original ssleay licen = (?:the )?original ssleay licen[cs]e
1 ncsa illinois ncsa open source licen = (?:the )?university of illinois ncsa open source licen[cs]e
1 w3c w3c software = (?:the )?w3c software (?:notice and )?(?:and document )?licen[cs]e
1 x11 x11 licen = (?:the )?x11 licen[cs]e
1 curl curl licen = (?:the )?curl licen[cs]e
1 ijg independent jpeg group licen = (?:the )?independent jpeg group licen[cs]e
1 freetype freetype licen = (?:the )?freetype licen[cs]e
1 freetype freetype project licen = (?:the )?freetype project licen[cs]e
1 imagemagick imagemagick licen = (?:the )?imagemagick licen[cs]e
1 vim vim licen = (?:the )?vim licen[cs]e
1 tcl tcl tk licen = (?:the )?tcl tk licen[cs]e
1 unicode unicode licen = (?:the )?unicode licen[cs]e(?: agreement)?(?: v3)?
1 icu icu licen = (?:the )?icu licen[cs]e
1 intel intel simplified software licen = (?:the )?intel simplified software licen[cs]e
1 ms-pl microsoft public licen = (?:the )?microsoft public licen[cs]e
1 ms-rl microsoft reciprocal licen = (?:the )?microsoft reciprocal licen[cs]e
1 apsl apple public source licen = (?:the )?apple public source licen[cs]e(?: version| v)?(?: 2 0)?
1 nasa-1.3 nasa open source agreement = (?:the )?nasa open source agreement(?: version| v)?(?: 1 3)?
1 osl-3 open software licen = (?:the )?open software licen[cs]e(?: version| v)?(?: 3 0)?
1 afl-3 academic free licen = (?:the )?academic free licen[cs]e(?: version| v)?(?: 3 0)?
1 ecl-2 educational community licen = (?:the )?educational community licen[cs]e(?: version| v)?(?: 2 0)?
1 upl-1.0 universal permissive licen = (?:the )?universal permissive licen[cs]e(?: version| v)?(?: 1 0)?
1 qpl-1.0 q public licen = (?:the )?q public licen[cs]e(?: version| v)?(?: 1 0)?
1 spl-1.0 sun public licen = (?:the )?sun public licen[cs]e(?: version| v)?(?: 1 0)?
1 npl netscape public licen = (?:the )?netscape public licen[cs]e(?: version| v)?(?: 1 1)?
1 rpl-1.5 reciprocal public licen = (?:the )?reciprocal public licen[cs]e(?: version| v)?(?: 1 5)?
1 cecill cecill = (?:the )?cecill(?: b| c)? licen[cs]e
1 mulanpsl-2 mulan permissive software licen = (?:the )?mulan permissive software licen[cs]e(?: version| v)?(?: 2)?
1 blueoak-1.0 blue oak model licen = (?:the )?blue oak model licen[cs]e(?: 1 0 0)?
1 elastic-2 elastic licen = (?:the )?elastic licen[cs]e(?: version| v)?(?: 2 0)?
3 elastic-2 spdx license identifier elastic 2 = spdx license identifier elastic 2 0
1 sspl-1 server side public licen = (?:the )?server side public licen[cs]e(?: version| v)?(?: 1)?
3 sspl-1 spdx license identifier sspl 1 = spdx license identifier sspl 1 0
1 polyform-nc polyform noncommercial licen = (?:the )?polyform noncommercial licen[cs]e(?: 1 0 0)?
1 prosperity prosperity public licen = (?:the )?prosperity public licen[cs]e(?: 3 0 0)?
1 parity parity public licen = (?:the )?parity public licen[cs]e(?: 7 0 0)?
1 beerware beerware licen = (?:the )?beerware licen[cs]e
4 beerware you can buy me a beer = (?:if we meet some day (?:[^ ]+ ){0,12})?you can buy me a beer in return
1 json json licen = (?:the )?json licen[cs]e
4 json shall be used for good not evil = the software shall be used for good not evil
3 ofl-1.1 spdx license identifier ofl 1 1 = spdx license identifier ofl 1 1
2 ofl-1.1 sil open font licen = (?:licensed under )?(?:the )?sil open font licen[cs]e (?:version |v |v)?1 1
1 ofl sil open font licen = (?:the )?sil open font licen[cs]e
1 ofl open font licen = (?:the )?open font licen[cs]e
1 gust-font gust font licen = (?:the )?gust font licen[cs]e
1 bitstream-vera bitstream vera licen = (?:the )?bitstream vera licen[cs]e
1 lppl latex project public licen = (?:the )?latex project public licen[cs]e(?: version| v)?(?: 1 3c?)?
3 odbl-1.0 spdx license identifier odbl 1 0 = spdx license identifier odbl 1 0
1 odbl open database licen = (?:the )?open database licen[cs]e(?: version| v)?(?: 1 0)?
1 odc-by open data commons attribution licen = (?:the )?open data commons attribution licen[cs]e(?: version| v)?(?: 1 0)?
1 pddl public domain dedication and licen = (?:the )?(?:open data commons )?public domain dedication and licen[cs]e
1 ogl open government licen = (?:the )?open government licen[cs]e(?: version| v)?(?: 3 0| 2 0| 1 0)?
1 cdla-permissive community data license agreement permissive = (?:the )?community data license agreement permissive(?: version| v)?(?: 2 0| 1 0)?
1 cdla-sharing community data license agreement sharing = (?:the )?community data license agreement sharing(?: version| v)?(?: 1 0)?
1 openrail open rail = (?:the )?(?:creativeml )?open rail(?: m)? licen[cs]e
1 openrail openrail m licen = (?:the )?(?:creativeml )?openrail m licen[cs]e
1 ogl-rpg open game licen = (?:the )?open game licen[cs]e(?: version| v)?(?: 1 0a?)?
1 fal free art licen = (?:the )?free art licen[cs]e(?: 1 3)?
1 dsl design science licen = (?:the )?design science licen[cs]e
1 opl open publication licen = (?:the )?open publication licen[cs]e(?: version| v)?(?: 1 0)?
1 cern-ohl cern open hardware licen = (?:the )?cern open hardware licen[cs]e(?: version| v)?(?: 2| 1 2)?
1 tapr-ohl tapr open hardware licen = (?:the )?tapr open hardware licen[cs]e
1 sleepycat sleepycat = (?:the )?sleepycat (?:public )?licen[cs]e
1 hpnd historical permission notice = (?:the )?historical permission notice and disclaimer
1 gl2ps gl2ps licen = (?:the )?gl2ps licen[cs]e
1 nokia nokia open source licen = (?:the )?nokia open source licen[cs]e
1 sissl sun industry standards source licen = (?:the )?sun industry standards source licen[cs]e
1 rsal redis source available licen = (?:the )?redis source available licen[cs]e(?: version| v)?(?: 2)?
"""


def rules() -> list[tuple[int, int, str, str, str]]:
    """(number, priority, label, keyword, expression) of each rule, in the order of the list."""
    out = []
    for line in RULES_TEXT.strip().splitlines():
        head, expression = line.split(" = ", 1)
        priority, label, keyword = head.split(" ", 2)
        out.append((len(out), int(priority), label, keyword, expression))
    return out
