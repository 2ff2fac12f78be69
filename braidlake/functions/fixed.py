"""Lists, patterns and tables that must equal the business rules they stand for."""

# Letters folded to plain ASCII, position by position.
ACCENTED = "ŠŽšžŸÁÇÉÍÓÚÀÈÌÒÙÂÊÎÔÛÃÕËÜÏÖÑÝåáçéíóúàèìòùâêîôûãõëüïöñýÿ"
UNACCENTED = "SZszYACEIOUAEIOUAEIOUAOEUIONYaaceiouaeiouaeiouaoeuionyy"

# Raw placeholders for "no date" and "no time".
BLANK_DATES = ("00000000", "0")
BLANK_TIMES = ("000000",)

# Maintenance activity codes: planned and corrective, for the legacy and the current system.
LEGACY_PLANNED = [
    "040", "045", "050", "055", "060", "300", "301", "303", "305", "306", "307", "308", "309",
    "310", "400", "405", "701", "702", "801",
]
LEGACY_CORRECTIVE = [
    "008", "200", "201", "202", "203", "204", "205", "206", "207", "208", "209", "210", "211",
    "212", "213", "600", "601", "602",
]
CURRENT_PLANNED = [
    "300", "301", "302", "303", "304", "305", "306", "307", "400", "401", "402", "403", "500",
    "600", "601", "602", "603", "604", "605", "606", "700",
]
CURRENT_CORRECTIVE = [
    "100", "200", "201", "202", "203", "204", "205", "206", "207", "208", "209", "210", "211",
    "212",
]
EXCLUDED_ACTIVITIES = ["E100", "E210", "H100", "H209"]

# Risk text codes look like "BL-1-02": area letters, impact digit, serial.
RISK_PREFIXES = ("BL", "QA", "SF", "EV")

# Locations: width of an area code, and the signs of a production line.
AREA_WIDTH = 5
LINE_WORD = "LIN"
LINE_GROUP = "-L-"
LINE_AFTER_GROUP = r"-L-(\w+)"
LINE_NUMBERED = r"^L[0-9]\w+"

# System status words that close a maintenance order.
CLOSED_STATUS_WORDS = ("CONF", "MREL", "NEXE", "ENTE", "ENCE", "NEJE", "PTBO")

# Sales rules of the order-item KPI fact.
SALE_STATUSES = ["FATURADO", "PARCIALMENTE_FATURADO"]
SALE_MOVEMENTS = ["VENDA", "UPSELL", "RENOVACAO"]
SALE_COMPANIES = ["B2B", "ENTERPRISE"]
DIGITAL_CHANNELS = ["E-COMMERCE", "APP", "PORTAL_B2B"]
MARGIN_ALERT_BELOW = 18
SLA_ALERT_BELOW = 92
TICKET_ALERT_BELOW = 350
