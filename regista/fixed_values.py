"""Fixed values of the open-data domain, stated plainly and in one place."""

# --- Fixed values: accented vowels that are folded, and what they become ---
FOLDED_ACCENTS = "áàéèíìóòúù"
FOLDED_TO = "aaeeiioouu"

# --- Fixed values: cleaning of the raw register ---
NULL_TEXT = "null"
COUNTY_RECODES = {"Val d'Aran": "Aran"}

# --- Fixed values: landing file names; page offsets have eight digits, more where they need them ---
REGISTER_FILE_GLOB = "{" + ",".join("[0-9]" * digits for digits in range(8, 20)) + "}.json"
CENSUS_FILE_GLOB = "[0-9]" * 4 + ".json"

# --- Fixed values: service types counted in the capacity mart ---
MART_SERVICE_TYPES = ("DAY-001", "RES-003", "RES-002", "TUT-001", "RES-001")
RESIDENCE_TYPE = "RES-003"

# --- Fixed values: calendar, indicator targets and colour thresholds ---
CALENDAR_FIRST_YEAR = 1975
CALENDAR_LAST_YEAR = 2025
REFERENCE_YEAR = 2000
COVERAGE_TARGET = 0.0411
COVERAGE_THRESHOLDS = (3, 4.11, 5, 7)
ELDERLY_THRESHOLD_COUNT = 8
ELDERLY_THRESHOLD_OFFSET = 7
ELDERLY_THRESHOLD_STEP = 2
DEFICIT_LABEL = "Dèficit"
SURPLUS_LABEL = "Superàvit"

# --- Fixed values: row-count rule ---
MINIMUM_EXPECTED_ROWS = 100

# --- Fixed values: format patterns of the register columns (not anchored) ---
REGISTER_PATTERNS = {
    "registre": r"S\d{5}",
    "inscripcio": r"[1-9]\d{3}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])",
    "capacitat": r"\d{1,3}",
    "cp": r"\d{5}",
    "nif": r"([A-Z0-9]\d{7}[A-Z0-9])|(null)",
}

# --- Fixed values: shape codes and their GeoJSON type ---
SHAPE_TYPES = {
    "Point": (1, 11, 21),
    "LineString": (3, 13, 23),
    "Polygon": (5, 15, 25),
    "MultiPoint": (8, 18, 28),
}
DEFAULT_SHAPE_TYPE = "Polygon"

# --- Fixed values: boundary level, its source field and its feature property ---
BOUNDARY_LEVELS = {
    "comarques": ("CODICOMAR", "comarca_id"),
    "municipis": ("CODIMUNI", "municipal_id"),
}

# --- Fixed values: service qualification catalog ---
SERVICE_QUALIFICATIONS = {
    "PUB-001": "Entitat d'iniciativa pública",
    "PRV-001": "Entitat privada d'iniciativa mercantil",
    "PRV-002": "Entitat privada d'iniciativa social",
}

# --- Fixed values: service type catalog (spelling and spacing as registered) ---
SERVICE_TYPES = {
    "ADD-001": "Servei de pis amb suport per a persones amb drogodependències (baixa i alta intensitat)",
    "ADD-002": "Servei de prevenció d'addiccions",
    "ASS-001": "Servei d'assistència personal de suport a la vida autònoma i d'integració social i comunitària, per a persones amb discapacitat física",
    "ASS-002": "Servei d'assistència personal de suport a la vida autònoma i d'integració social i comunitària, per a persones amb discapacitat sensorial sord-ceguesa",
    "ASS-003": "Servei d'assistència personal de suport a la vida autònoma id'integració social i comunitària, per a persones amb discapacitat intel·lectual",
    "ASS-004": "Servei d'assistència personal de suport en l'acompanyament a activitats laborals, ocupacionals i/o formatives, per a persones amb discapacitat física",
    "ASS-005": "Servei d'assistència personal de suport en l'acompanyament a activitats laborals, ocupacionals i/o formatives, per persones amb discapacitat sensorial sord-ceguesa",
    "BAS-001": "Servei bàsic d'atenció social",
    "BAS-002": "Servei d'assessorament tècnic d'atenció social",
    "BAS-003": "Servei d'orientació",
    "BAS-004": "Servei de valoració",
    "BAS-005": "Servei de valoració a la dependència",
    "BAS-006": "Servei de suport als serveis socials bàsics",
    "BAS-007": "Servei de suport als serveis socials bàsics ( Distribució d'aliments)",
    "BAS-008": "Servei de suport als serveis socials bàsics ( Maternoinfantil)",
    "BAS-009": "Servei de suport social als serveis socials especialitzats",
    "DAY-001": "Servei de centre de dia per a gent gran de caràcter temporal o permanent",
    "DAY-002": "Servei de centre per a l'autonomia personal",
    "DAY-003": "Espai alternatiu d'atenció diürna temporal",
    "DAY-011": "Servei de centre de dia d'atenció especialitzada temporal o permanent per a persones amb discapacitat física",
    "DAY-012": "Servei de centre de dia d'atenció especialitzada temporal o permanent per a persones amb discapacitat intel·lectual",
    "DAY-013": "Servei de centre de dia de teràpia ocupacional (STO) per a  persones amb discapacitat física",
    "DAY-014": "Servei de centre de dia de teràpia ocupacional per a persones amb discapacitat intel·lectual (STO)",
    "DAY-015": "Servei de centre de dia ocupacional d'inserció (SOI) per a  persones amb discapacitat física",
    "DAY-016": "Servei de centre de dia ocupacional d'inserció per a persones amb discapacitat intel·lectual (SOI)",
    "DAY-021": "Servei de centre de dia per a persones amb addiccions",
    "DAY-022": "Servei de club social (mòdul A / mòdul B)",
    "EXP-001": "Servei experimental",
    "EXP-002": "Servei experimental (Servei de temps lliure per a discapacitats físics)",
    "EXP-003": "Servei experimental (Tutela discapacitats físics-diversa)",
    "FAM-001": "Servei d'atenció a les famílies (amb problemàtica social de risc d'exclusió social)",
    "FAM-002": "Servei d'atenció precoç",
    "FAM-003": "Servei de suport a l'adopció internacional",
    "HIV-001": "Servei de prevenció per a persones afectades pel virus VIH/SIDA",
    "HIV-002": "Servei temporal de llar amb suport per a persones afectades pel virus VIH/SIDA (baixa/alta intensitat)",
    "HIV-003": "Servei temporal de llar residència per a persones afectades pel virus  VIH/SIDA",
    "HOM-001": "Servei d'ajuda a domicili",
    "HOM-002": "Servei de suport a l'autonomia a la pròpia llar per a persones amb discapacitat física",
    "HOM-003": "Servei de suport a l'autonomia a la pròpia llar per a persones amb discapacitat intel·lectual",
    "HOM-004": "Servei de suport a l'autonomia a la pròpia llar per a persones amb problemàtica social derivada de malaltia mental",
    "HOM-005": "Servei de suport als familiars cuidadors/es i altres cuidadors/es no professionals",
    "PRE-001": "Servei de prevenció de les situacions de dependència",
    "RES-001": "Servei d' habitatge tutelat per a gent gran de caràcter temporal o permanent",
    "RES-002": "Servei de llar residència per a gent gran de caràcter temporal o permanent",
    "RES-003": "Servei de residència assistida per a gent gran de caràcter temporal o permanent",
    "RES-011": "Servei de centre residencial temporal o permanent per a persones amb discapacitat física",
    "RES-012": "Servei de centre residencial temporal o permanent per a persones amb discapacitat intel·lectual",
    "RES-013": "Servei de llar amb suport per a persones amb discapacitat física",
    "RES-014": "Servei de llar amb suport per a persones amb discapacitat intel·lectual",
    "RES-015": "Servei de llar residència temporal o permanent per a persones amb discapacitat física",
    "RES-016": "Servei de llar residència temporal o permanent per a persones amb discapacitat intel·lectual",
    "RES-021": "Servei de llar amb suport temporal o permanent per a persones amb problemàtica social derivada de malaltia mental",
    "RES-022": "Servei de llar residència temporal o permanent per a persones amb problemàtica social derivada de malaltia mental",
    "RES-023": "Servei de residència temporal per a persones adultes en situació d'exclusió social",
    "RES-024": "Servei d'acolliment residencial d'urgència",
    "RES-025": "Casal per a altres col·lectius",
    "RUR-001": "Servei d'atenció integral a les persones grans en l'àmbit rural",
    "SUP-001": "Servei d'intèrpret per a persones sordes",
    "SUP-002": "Servei de les tecnologies de suport i cura",
    "SUP-003": "Servei de transport adaptat",
    "SUP-004": "Servei de menjador social",
    "SUP-005": "Servei de temps lliure per a persones amb discapacitat intel·lectual",
    "TUT-001": "Servei de tutela per a gent gran",
    "TUT-002": "Servei de tutela per a persones amb discapacitat intel·lectual",
    "TUT-003": "Servei de tutela per a persones amb malaltia mental",
    "WOR-001": "Servei prelaboral",
}
