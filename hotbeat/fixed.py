"""Fixed values that must equal the source workflow's for equal results.

Everything in this module is data, not logic: code tables and constants
stated as plain text in their original order.  Loaders below only split
the text into rows.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: offence code -> category (139 entries, "code|category").
# One label carries a trailing blank in the source; it is trimmed on load.
# ---------------------------------------------------------------------------
CATEGORY_CODES_TEXT = """\
230|AGG. ASSAULTS
231|AGG. ASSAULTS
235|AGG. ASSAULTS
236|AGG. ASSAULTS (DV)
250|AGG. ASSAULTS (DV)
251|AGG. ASSAULTS (DV)
761|AGG. ASSAULTS (DV)
926|AGG. ASSAULTS (DV)
330|BTFV
331|BTFV
410|BTFV
420|BTFV
421|BTFV
310|BURGLARY
320|BURGLARY
110|HOMICIDE
113|HOMICIDE
354|IDENTITY THEFT
433|MVT (GTA)
510|MVT (GTA)
520|MVT (GTA)
522|MVT (GTA)
341|OTHER THEFT
343|OTHER THEFT
345|OTHER THEFT
440|OTHER THEFT
441|OTHER THEFT
442|OTHER THEFT
443|OTHER THEFT
444|OTHER THEFT
445|OTHER THEFT
470|OTHER THEFT
471|OTHER THEFT
473|OTHER THEFT
474|OTHER THEFT
475|OTHER THEFT
480|OTHER THEFT
485|OTHER THEFT
487|OTHER THEFT
350|PERSONAL THFT 
351|PERSONAL THFT 
352|PERSONAL THFT 
353|PERSONAL THFT 
450|PERSONAL THFT 
451|PERSONAL THFT 
452|PERSONAL THFT 
121|RAPE
122|RAPE
815|RAPE
820|RAPE
821|RAPE
210|ROBBERY
220|ROBBERY
435|SIMPLE ASSAULT
436|SIMPLE ASSAULT
437|SIMPLE ASSAULT
622|SIMPLE ASSAULT
623|SIMPLE ASSAULT
624|SIMPLE ASSAULT
625|SIMPLE ASSAULT
626|SIMPLE ASSAULT (DV)
627|SIMPLE ASSAULT (DV)
647|SIMPLE ASSAULT (DV)
763|SIMPLE ASSAULT (DV)
928|SIMPLE ASSAULT (DV)
930|SIMPLE ASSAULT (DV)
888|Trespassing
740|Vandalism
745|Vandalism
237|SIMPLE ASSAULT (DV)
347|FRAUD
349|MVT (GTA)
432|SIMPLE ASSAULT
434|SIMPLE ASSAULT
438|SIMPLE ASSAULT
439|SIMPLE ASSAULT
446|OTHER THEFT
648|ARSON
649|IDENTITY THEFT
651|IDENTITY THEFT
652|IDENTITY THEFT
653|FRAUD
654|FRAUD
660|All Other Offenses
661|FRAUD
662|OTHER THEFT
664|OTHER THEFT
666|OTHER THEFT
668|Embezzlement
670|Embezzlement
753|All Other Offenses
755|All Other Offenses
756|All Other Offenses
760|All Other Offenses
762|All Other Offenses
805|All Other Offenses
806|All Other Offenses
810|All Other Offenses
812|All Other Offenses
813|All Other Offenses
814|All Other Offenses
822|HUMAN TRAFFICKING
830|All Other Offenses
840|All Other Offenses
845|All Other Offenses
850|All Other Offenses
860|All Other Offenses
865|All Other Offenses
870|All Other Offenses
880|All Other Offenses
882|All Other Offenses
884|All Other Offenses
886|All Other Offenses
890|All Other Offenses
900|All Other Offenses
901|All Other Offenses
902|All Other Offenses
903|All Other Offenses
904|All Other Offenses
906|All Other Offenses
910|HUMAN TRAFFICKING
920|HUMAN TRAFFICKING
921|HUMAN TRAFFICKING
922|HUMAN TRAFFICKING
924|All Other Offenses
931|All Other Offenses
932|All Other Offenses
933|All Other Offenses
940|All Other Offenses
942|All Other Offenses
943|All Other Offenses
944|All Other Offenses
946|All Other Offenses
948|All Other Offenses
949|All Other Offenses
950|FRAUD
951|FRAUD
954|All Other Offenses
956|All Other Offenses
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: victim descent code -> label (19 codes).  Any other code,
# including null, becomes "Unknown".
# ---------------------------------------------------------------------------
DESCENT_CODES_TEXT = """\
A|Other Asian
B|Black
C|Chinese
D|Cambodian
F|Filipino
G|Guamanian
H|Hispanic/Latin/Mexican
I|American Indian/Alaskan Native
J|Japanese
K|Korean
L|Laotian
O|Other
P|Pacific Islander
S|Samoan
U|Hawaiian
V|Vietnamese
W|White
X|Unknown
Z|Asian Indian
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: victim age bands, inclusive bounds "label|low|high".
# Below 1 is "Infant", above 65 "Senior", null "Unknown".
# ---------------------------------------------------------------------------
AGE_BANDS_TEXT = """\
Toddler|1|4
Kid|5|12
Teenager|13|17
Young Adult|18|25
Adult|26|39
Middle Age|40|65
"""

# FIXED VALUES: the ten categories counted as violent; all others "Property".
VIOLENT_CATEGORIES = ["SIMPLE ASSAULT", "RAPE", "AGG. ASSAULTS", "SIMPLE ASSAULT (DV)",
                      "AGG. ASSAULTS (DV)", "ARSON", "HUMAN TRAFFICKING", "Trespassing",
                      "HOMICIDE", "ROBBERY"]

# FIXED VALUES: victim-sex codes merged into "X", and the fill for null sex.
SEX_MERGE = {"H": "X", "-": "X"}
SEX_FILL = "X"

# FIXED VALUES: shift boundaries (hours).  hour < 8 -> 1, < 16 -> 2, else 3.
SHIFT_BOUNDS = (8, 16)

# FIXED VALUES: text timestamp pattern of the raw incident extract.
RAW_TS_PATTERN = "MM/dd/yyyy hh:mm:ss a"

# FIXED VALUES: the ten hotspots recorded for area 1 (id|lat|lon).  Used as a
# golden input in tests only; registered queries derive hotspots from data.
AREA1_HOTSPOTS_TEXT = """\
0|34.036454545454546|-118.26722727272727
1|34.04208787878788|-118.2468686868687
2|34.05622727272727|-118.2376
3|34.048360606060605|-118.26308181818182
4|34.06184747474747|-118.2468090909091
5|34.06428181818182|-118.23791818181817
6|34.046469696969694|-118.25197272727273
7|34.045980808080806|-118.23947171717171
8|34.04959090909091|-118.24594848484848
9|34.04322222222222|-118.2692888888889
"""


def _rows(text: str) -> list[list[str]]:
    return [ln.split("|") for ln in text.splitlines() if ln.strip()]


def category_codes() -> list[tuple[int, str]]:
    return [(int(c), lab.strip()) for c, lab in _rows(CATEGORY_CODES_TEXT)]


def descent_codes() -> list[tuple[str, str]]:
    return [(c, lab) for c, lab in _rows(DESCENT_CODES_TEXT)]


def age_bands() -> list[tuple[str, int, int]]:
    return [(lab, int(lo), int(hi)) for lab, lo, hi in _rows(AGE_BANDS_TEXT)]


def area1_hotspots() -> list[tuple[int, float, float]]:
    return [(int(i), float(a), float(o)) for i, a, o in _rows(AREA1_HOTSPOTS_TEXT)]
