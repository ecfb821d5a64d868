"""Lookup tables of the audit: thresholds, self-insured firms, diagnoses, contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import literal_table

# --- fixed values -----------------------------------------------------------
DEFAULT_THRESHOLD = 40000.0
DEFAULT_MODEL = "M39"
# (provider tax id - coverage, model, amount)
THRESHOLDS = [
    ("20101039910-ONCOLOGIA", "M1", 152.16), ("20501781291-AMBULATORIO", "M2", 4175.59),
    ("20454135432-AMBULATORIO", "M3", 2685.45), ("20100251176-AMBULATORIO", "M4", 1643.06),
    ("20546292658-AMBULATORIO", "M5", 1533.48), ("20501781291-EMERGENCIA", "M6", 2982.07),
    ("20102756364-AMBULATORIO", "M7", 1843.25), ("20394674371-AMBULATORIO", "M8", 1951.53),
    ("20501781291-MATERNIDAD", "M9", 3667.84), ("20394674371-PREVENCION", "M10", 853.68),
    ("20454135432-EMERGENCIA", "M11", 1449.85), ("20546292658-EMERGENCIA", "M12", 2172.90),
    ("20100251176-EMERGENCIA", "M13", 1538.13), ("20102756364-PREVENCION", "M14", 519.47),
    ("20381170412-ONCOLOGIA", "M15", 19334.91), ("20381170412-AMBULATORIO", "M16", 1286.69),
    ("20501781291-ONCOLOGIA", "M17", 11842.81), ("20102756364-EMERGENCIA", "M18", 1887.66),
    ("20501781291-HOSPITALARIO", "M19", 80000.0), ("20454135432-MATERNIDAD", "M20", 2603.76),
    ("20454135432-PREVENCION", "M21", 1872.20), ("20546292658-ONCOLOGIA", "M22", 4617.20),
    ("20454135432-ONCOLOGIA", "M23", 10573.66), ("20501781291-PREVENCION", "M24", 1194.13),
    ("20546292658-MATERNIDAD", "M25", 1956.74), ("20454135432-HOSPITALARIO", "M26", 29315.64),
    ("20100251176-MATERNIDAD", "M27", 2234.24), ("20381170412-EMERGENCIA", "M28", 2111.45),
    ("20102756364-ONCOLOGIA", "M29", 6035.15), ("20102756364-MATERNIDAD", "M30", 1375.09),
    ("20546292658-PREVENCION", "M31", 159.29), ("20546292658-HOSPITALARIO", "M32", 19866.88),
    ("20100251176-HOSPITALARIO", "M33", 36651.96), ("20100251176-PREVENCION", "M34", 55.00),
    ("20102756364-HOSPITALARIO", "M35", 29795.44), ("20102756364-OTROS", "M36", 50.00),
    ("20381170412-PREVENCION", "M37", 6115.63), ("20394674371-ONCOLOGIA", "M38", 2774.73),
]
# (tax id or null, registered name)
SELF_INSURED = [
    (None, "Backus Estrategia S.A.C."), ("20602207731", "Backus Servicio de Ventas S.A.C."),
    ("20128915711", "Cervecería San Juan S.A."), ("20510014279", "Club Sporting Cristal S.A."),
    ("20114915026", "Compañía Minera Antapaccay S.A."), ("20161749126", "Congreso de la Republica"),
    ("20423924137", "Fundación Telefónica del Perú"), ("20600299884", "Gesnext Perú S.A.C."),
    ("20501827623", "Gestión de Servicios Compartidos S.A.C."), ("20605061096", "Govertis Advisory Services Perú S.A.C."),
    ("20373697720", "Grupo Repsol del Perú S.A.C."), ("20607527661", "Hispasat Perú S.A.C."),
    ("20602982174", "Internet para Todos"), ("20335955065", "Media Networks Latin America S.A.C."),
    ("20501633004", "Media Networks"), ("20128847881", "Naviera Oriente S.A.C."),
    (None, "Refinería La Pampilla S.A.A."), ("20503840121", "Repsol Comercial S.A.C."),
    ("20258262728", "Repsol Exploración Perú Sucursal del Perú"), ("20606862556", "Semod S.A.C."),
    (None, "Telefónica Cybersecurity Tech Perú S.A.C."), ("20100070970", "Telefónica del Perú"),
    (None, "Telefónica Factoring Perú"), ("20501827623", "Telefónica Gestión de Servicios Compartidos Perú S.A.C."),
    (None, "Telefónica Ingeniería de Seguridad Perú S.A.C."), (None, "Telefónica International Wholesale Services Perú S.A.C."),
    (None, "Telefónica Learning Services Perú S.A.C."), (None, "Telefónica Móviles"),
    (None, "Telefónica Multimedia S.A.C."), ("20607092851", "Telefónica On The Spot Soluciones Digitales Perú S.A.C."),
    (None, "Telefónica Servicios Comerciales"), (None, "Telefónica Servicios TIWS Sociedad Anónima"),
    (None, "Telxius Cable Perú S.A.C."), (None, "Telxius Torres Perú S.A.C."),
    (None, "Terra Network Perú S.A."), (None, "Tgestiona Logística S.A.C."),
    (None, "Tgestiona Servicios Contables y Capital Humano S.A.C."), ("20606862556", "Tgestiona Servicios Globales"),
    (None, "Transportes 77 S.A."), (None, "Unión de Cervecerías Peruanas Backus y Johnston S.A.A."),
    (None, "Wayra Perú Aceleradora de Proyectos S.A.C."),
]
# Letter diagnosis (normal form) -> diagnosis as the discharge summary writes it.  A key
# with an N-tilde can never match, because the normal form has none.
DIAGNOSIS_EQUIVALENCES = [
    ("TUMOR MALIGNO DE LA PROSTATA", "HIPERPLASIA DE LA PROSTATA"),
    ("OTROS TRASTORNOS DE LOS MENISCOS", "DESGARRO DE MENISCOS, PRESENTE"),
    ("TRASTORNO DE MENISCO DEBIDO A DESGARRO O LESION ANTIGUA", "DESGARRO DE MENISCOS, PRESENTE"),
    ("DESGARRO DE MENISCOS, PRESENTE", "DESGARRO DE MENISCOS, PRESENTE"),
    ("INSUFICIENCIA RENAL CRONICA, NO ESPECIFICADA", "Insuficiencia Renal Crónica. (antecedente)"),
    ("ANGINA DE PECHO CON ESPASMO DOCUMENTADO", "Cardiopatía Coronaria Isquémica (antecedente)"),
    ("ENFERMEDAD ATEROSCLEROTICA DEL CORAZON", "Cardiopatía Coronaria Isquémica (antecedente)"),
    ("TUMOR MALIGNO DE LA GLANDULA TIROIDES", "TUMOR MALIGNO DE LA GLANDULA TIROIDES"),
    ("APENDICITIS AGUDA CON ABSCESO PERITONEAL", "APENDICITIS AGUDA CON PERITONITIS GENERALIZADA"),
    ("HIPERPLASIA DE LA PROSTATA", "HIPERPLASIA DE LA PROSTATA"),
    ("OTROS DOLORES ABDOMINALES Y LOS NO ESPECIFICADOS", "DOLORES ABDOMINALES Y LOS NO ESPECIFICADOS"),
    ("COMPRESIONES DE LAS RAICES Y PLEXOS NERVIOSOS EN LA ESPONDILOSIS (M47.-+)", "COMPRESIONES DE LAS RAICES Y PLEXOS NERVIOSOS EN TRASTORNOS DE LOS DISCOS INTERVERTEBRALES (M50-M51"),
    ("FIBRILACION Y ALETEO AURICULAR", "Fibrilación Atrial Paroxística (antecedente)"),
    ("ENFERMEDAD CARDIOVASCULAR ATEROSCLEROTICA, ASI DESCRITA", "Cardiopatía Coronaria Isquémica (antecedente)"),
    ("CALCULO DE CONDUCTO BILIAR SIN COLANGITIS NI COLECISTITIS", "CALCULO DE LA VESICULA BILIAR SIN COLELITIASIS"),
    ("INFARTO AGUDO DEL MIOCARDIO, SIN OTRA ESPECIFICACION", "Cardiopatía Coronaria Isquémica (antecedente)"),
    ("LEIOMIOMA DEL UTERO, SIN OTRA ESPECIFICACION", "LEIOMIOMA DEL UTERO, SIN OTRA ESPECIFICACION"),
    ("PARTO POR CESAREA, SIN OTRA ESPECIFICACION", "CP. CESAREA (CUALQUIER TIPO)"),
    ("ATENCION MATERNA POR CICATRIZ UTERINA DEBIDA A CIRUGIA PREVIA", "ATENCION MATERNA POR CICATRIZ UTERINA DEBIDA A CIRUGIA PREVIA"),
    ("PANCREATITIS AGUDA", "PANCREATITIS AGUDA"),
    ("HEMORRAGIA INTRAENCEFALICA, NO ESPECIFICADA", "HEMORRAGIA INTRAENCEFALICA, NO ESPECIFICADA"),
    ("PARTO UNICO ESPONTANEO, SIN OTRA ESPECIFICACION", "PARTO UNICO ESPONTANEO, SIN OTRA ESPECIFICACION"),
    ("PARTO UNICO ESPONTANEO, PRESENTACION CEFALICA DE VERTICE", "PARTO UNICO ESPONTANEO, PRESENTACION CEFALICA DE VERTICE"),
    ("CARDIOMIOPATIA ISQUEMICA", "Cardiopatía Coronaria Isquémica (antecedente)"),
    ("DESVIACION DEL TABIQUE NASAL", "Desviación de tabique nasal"),
    ("PARTO VAGINAL EUTOSICO O DISTOSICO -C/S EPISIO C/S TRAQUELO, PARTO UNICO ESPONTANEO, SIN OTRA ESPECIFICACION", "PARTO UNICO ESPONTANEO, SIN OTRA ESPECIFICACION"),
    ("OTRAS FRACTURAS DE OTROS DEDOS DE LA MANO", "FRACTURA DE OTRO DEDO DE LA MANO"),
    ("PARTO VAGINAL EUTOSICO O DISTOSICO -C/S EPISIO C/S TRAQUELO, PARTO UNICO ESPONTANEO, PRESENTACION CEFALICA DE VERTICE", "PARTO UNICO ESPONTANEO, PRESENTACION CEFALICA DE VERTICE"),
    ("FIBRILACION AURICULAR", "Fibrilación Atrial Paroxística (antecedente)"),
    ("FRACTURA DE OTRO DEDO DE LA MANO", "FRACTURA DE OTRO DEDO DE LA MANO"),
    ("DOLOR LOCALIZADO EN OTRAS PARTES INFERIORES DEL ABDOMEN", "DOLORES ABDOMINALES Y LOS NO ESPECIFICADOS"),
    ("RUPTURA TRAUMATICA DE LIGAMENTOS DE LA MUÑECA Y DEL CARPO", "RUPTURA TRAUMATICA DE LIGAMENTOS DE LA MUÑECA Y DEL CARPO"),
    ("CALCULO DE LA VESICULA BILIAR CON COLECISTITIS AGUDA", "CALCULO DE LA VESICULA BILIAR CON COLECISTITIS AGUDA"),
    ("CALCULO DE LA VESICULA BILIAR CON OTRA COLECISTITIS", "CALCULO DE LA VESICULA BILIAR CON OTRA COLECISTITIS"),
    ("CP. CESAREA (CUALQUIER TIPO)", "CP. CESAREA (CUALQUIER TIPO)"),
    ("RIGIDEZ ARTICULAR, NO CLASIFICADA EN OTRA PARTE", "RIGIDEZ ARTICULAR, NO CLASIFICADA EN OTRA PARTE"),
    ("ISQUEMIA CEREBRAL TRANSITORIA, SIN OTRA ESPECIFICACION", "ISQUEMIA CEREBRAL TRANSITORIA, SIN OTRA ESPECIFICACION"),
    ("TUMOR MALIGNO DE GLANDULA SALIVAL MAYOR, NO ESPECIFICADA", "TUMOR MALIGNO DE GLÁNDULA SALIVAL MAYOR, NO ESPECIFICADA"),
    ("FRACTURA DE LA EPIFISIS SUPERIOR DE LA TIBIA", "FRACTURA DE LA EPIFISIS SUPERIOR DE LA TIBIA"),
    ("FIEBRE DEL DENGUE", "FIEBRE DEL DENGUE [DENGUE CLASICO]"),
    ("APENDICITIS AGUDA, NO ESPECIFICADA", "APENDICITIS AGUDA, NO ESPECIFICADA"),
    ("COMPRESIONES DE LAS RAICES Y PLEXOS NERVIOSOS EN TRASTORNOS DE LOS DISCOS INTERVERTEBRALES (M50-M51", "COMPRESIONES DE LAS RAICES Y PLEXOS NERVIOSOS EN TRASTORNOS DE LOS DISCOS INTERVERTEBRALES (M50-M51"),
    ("LINFOMA DE CELULAS B, SIN OTRA ESPECIFICACION", "LINFOMA DE CELULAS B, SIN OTRA ESPECIFICACION"),
    ("CELULITIS DE OTRAS PARTES DE LOS MIEMBROS", "CELULITIS DE SITIO NO ESPECIFICADO"),
    ("ADHERENCIAS PERITONEALES", "ADHERENCIAS [BRIDAS] INTESTINALES CON OBSTRUCCION"),
    ("COLECISTITIS AGUDA", "COLECISTITIS AGUDA"),
    ("MIGRANA COMPLICADA", "Migraña (antecedente)"),
    ("LEIOMIOMA INTRAMURAL DEL UTERO", "LEIOMIOMA DEL UTERO, SIN OTRA ESPECIFICACION"),
    ("TUMOR MALIGNO DEL HIGADO, NO ESPECIFICADO", "TUMOR MALIGNO SECUNDARIO DEL HIGADO"),
    ("FIEBRE DEL DENGUE [DENGUE CLASICO]", "FIEBRE DEL DENGUE [DENGUE CLASICO]"),
    ("CELULITIS DE SITIO NO ESPECIFICADO", "CELULITIS DE SITIO NO ESPECIFICADO"),
    ("ADHERENCIAS [BRIDAS] INTESTINALES CON OBSTRUCCION", "ADHERENCIAS [BRIDAS] INTESTINALES CON OBSTRUCCION"),
]
# Claim coverage class by coverage id; any other id keeps the mart's own class.
COVERAGE_IDS = {
    "AMBULATORIO": ["P09", "A70", "A71", "R29", "Q05", "L12"],
    "PREVENCION": ["R24", "R25", "R26", "R27", "R28", "A74", "V21"],
    "HOSPITALARIO": ["H05", "M20"],
    "EMERGENCIA": ["E18"],
    "ONCOLOGIA": ["O11"],
}
CHRONIC_CONTRACTS = {
    "PACIENTE MES DIABETES": [154, 189, 4],
    "PACIENTE MES DISLIPIDEMIA": [156, 191, 6],
    "PACIENTE MES ASMA": [153, 188, 3],
    "PACIENTE MES ANEMIA": [322],
}
NOT_CHRONIC = 9999
# Providers by clinic group; the first group is the audited network itself.
NETWORK_PROVIDERS = ["20546292658", "20501781291", "20454135432", "20394674371", "20381170412", "20102756364", "20100251176"]
OTHER_CLINIC_GROUPS = {
    "CI": ["20100054184"],
    "AngloAmerican": ["20107695584"],
    "Ricardo Palma": ["20100121809"],
    "San Pablo": ["20544206410", "20517737560", "20107463705", "20517738701", "20505018509", "20508790971", "20502454111", "20601725551"],
    "Sanna": ["20136096592", "20507264108", "20507775889", "20112280201", "20100162742"],
}
# Six-month limit of self-insured contracts: this provider with these firms.
SHORT_LIMIT_PROVIDER = "20100054184"
SHORT_LIMIT_FIRMS = ["20423924137", "20100070970", "20501827623", "20607092851", "20606862556"]
INSURER_EPS, INSURER_GENERAL = "20414955020", "20100041953"
DEFINITIVE_REFUND_REASONS = [382, 376]
SETTLED_STATES = ["4", "8", "T"]
REFUNDED_STATE = "5"
RESERVED_STATES = ["D", "R", "E", "3", "2", "9", "1", "V", "0"]
# --- end of fixed values ----------------------------------------------------

ALL_PROVIDERS = NETWORK_PROVIDERS + [p for group in OTHER_CLINIC_GROUPS.values() for p in group]


def thresholds(spark: SparkSession) -> DataFrame:
    return literal_table(spark, THRESHOLDS, "key string, modelo string, umbral double")


def self_insured(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SELF_INSURED, "RUC string, razon_social string")


def diagnosis_equivalences(spark: SparkSession) -> DataFrame:
    return literal_table(spark, DIAGNOSIS_EQUIVALENCES, "dx_norm string, dx string")


def clinic_groups(network: str) -> dict[str, str]:
    """Provider tax id -> clinic group."""
    groups = {network: NETWORK_PROVIDERS, **OTHER_CLINIC_GROUPS}
    return {ruc: group for group, members in groups.items() for ruc in members}
