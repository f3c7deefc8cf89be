"""Fixed values of the wire format.

Everything in this module is given from outside (type names, markers, word
lists) and has to be spelled exactly like this for results to be right.
"""

# Separator of multi-part values and prefix of attribute names.
DELIM = ";#"
WIRE_PREFIX = "ows_"

# The property bag column, never decoded and never kept.
PROPERTY_BAG = "MetaInfo"

# Declared type of the system columns when a list schema does not name them.
SYSTEM_FIELD_TYPES = {
    "ID": "Counter",
    "UniqueId": "Text",
    "GUID": "Text",
    "Created": "DateTime",
    "Modified": "DateTime",
    "Created_x0020_Date": "DateTime",
    "Last_x0020_Modified": "DateTime",
    "Author": "User",
    "Editor": "User",
    "ContentType": "Text",
    "ContentTypeId": "Text",
    "FSObjType": "Integer",
    "FileRef": "Lookup",
    "FileLeafRef": "Lookup",
    "FileDirRef": "Lookup",
    "EncodedAbsUrl": "Text",
    "AttachmentUrls": "Text",
    "Attachments": "Attachments",
    "owshiddenversion": "Integer",
    "_ModerationStatus": "Integer",
    "_Level": "Integer",
    "Order": "Number",
    "PermMask": "Text",
    "ServerUrl": "Text",
    "BaseName": "Text",
    "FileSizeDisplay": "Integer",
}

# System columns that an explicit projection always asks for, in this order.
ALWAYS_PROJECTED = [
    "ID",
    "UniqueId",
    "GUID",
    "Created",
    "Modified",
    "Author",
    "Editor",
    "ContentType",
    "FSObjType",
    "FileRef",
    "FileLeafRef",
    "EncodedAbsUrl",
    "Attachments",
]

# Declared type -> decode rule. Types not named here are text.
NUMBER_TYPES = ["Number", "Currency", "AverageRating"]
INTEGER_TYPES = ["Counter", "Integer", "RatingCount", "Likes", "ModStat"]
BOOLEAN_TYPES = ["Boolean", "AllDayEvent"]
DATETIME_TYPES = ["DateTime"]
CHOICE_TYPES = ["Choice"]
MULTI_CHOICE_TYPES = ["MultiChoice", "GridChoice"]
LOOKUP_TYPES = ["Lookup", "User", "File"]
LOOKUP_MULTI_TYPES = ["LookupMulti", "UserMulti"]
TAXONOMY_TYPES = ["TaxonomyFieldType"]
TAXONOMY_MULTI_TYPES = ["TaxonomyFieldTypeMulti"]
URL_TYPES = ["URL"]
FLAG_TYPES = ["Attachments"]

# Prefixes of self-describing calculated values -> decode rule.
CALCULATED_NUMBER = ["float", "number", "currency", "double"]
CALCULATED_INTEGER = ["int", "integer", "counter"]
CALCULATED_DATETIME = ["datetime", "date"]
CALCULATED_BOOLEAN = ["boolean", "bool"]
CALCULATED_TEXT = ["string", "text", "note", "lookup", "choice"]

TRUE_WORDS = ["1", "true", "yes", "on", "-1"]
FALSE_WORDS = ["0", "false", "no", "off"]

# Characters removed at both ends of a value.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Namespace of name-based ids for urls (RFC 4122, appendix C).
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"

BASE_TYPE_NAMES = {
    "0": "generic_list",
    "1": "document_library",
    "3": "discussion_board",
    "4": "survey",
    "5": "issue_tracking",
}

SYSTEM_LIST_TITLES = [
    "Master Page Gallery",
    "Web Part Gallery",
    "List Template Gallery",
    "Site Template Gallery",
    "User Information List",
    "Solution Gallery",
    "Style Library",
    "Form Templates",
    "Workflow History",
    "TaskAttachments",
    "Reporting Metadata",
    "Reporting Templates",
    "Converted Forms",
]

# A list longer than this is throttled by servers of the major version below.
VIEW_THRESHOLD = 5000
THRESHOLD_SINCE_MAJOR = 14

# Markers of a throttling fault, in the two languages the servers speak.
THROTTLE_MARKERS = [
    "list view threshold",
    "exceeds the list view",
    "listenansichtsschwellenwert",
    "schwellenwert für die listenansicht",
    "0x80070024",
]

# Spellings of the well-known columns.
KEY_ALIASES = ["Id", "ID"]
CREATED_ALIASES = ["Created", "Erstellt"]
HOUSEKEEPING_KEYS = [
    "CreatedById",
    "ModifiedById",
    "ContentTypeID",
    "ErstelltVonId",
    "GeändertVonId",
    "InhaltstypID",
]

# Keys the feed adds to every entity, never list data.
CONTROL_KEYS = ["__metadata", "__deferred", "__next", "__count"]

FILE_KINDS = {
    "archive": [".zip", ".rar", ".7z", ".tar", ".gz", ".tgz", ".cab"],
    "document": [".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".rtf", ".odt", ".msg", ".eml"],
    "image": [".png", ".jpg", ".jpeg", ".gif", ".bmp", ".tif", ".tiff", ".heic"],
    "text": [".txt", ".log", ".csv", ".xml", ".json", ".ini", ".cfg", ".yml", ".yaml"],
    "video": [".mp4", ".avi", ".mov", ".mkv", ".wmv"],
}

MAX_FILE_NAME = 120
MAX_KEPT_EXTENSION = 10
MAX_SLUG = 150

REDACTED = "***REDACTED***"
MIN_SECRET = 3

UNKNOWN_OPERATION_MARKER = "did not recognize the value of http header soapaction"

# Patterns of the wire format: an escaped character of a column name, a feed date, what may not stand in the
# folder name of a web and in a file name, the start of a fault and a whole one (both whatever the case).
ESCAPED_CHARACTER = r"_x([0-9A-Fa-f]{4})_"
FEED_DATE = r"^/Date\((-?\d+)(?:([+-])(\d{2})(\d{2}))?\)/$"
UNSAFE_IN_SLUG = r"[^0-9a-zA-Z._-]+"
UNSAFE_IN_FILE_NAME = r'[<>:"/\\|?*\x00-\x1f]'
FAULT_START = r"<\s*(?:[a-z0-9_.-]+:)?fault(?:string)?[\s>/]"
FAULT = r"<(?:[\w.-]+:)?Fault(?:\s[^>]*)?>(.*?)</(?:[\w.-]+:)?Fault\s*>"
