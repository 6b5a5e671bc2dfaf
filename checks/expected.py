"""Fixed values that the oracles expect.

Kept apart from the library's own lists, so that a slip in those shows as a difference.
Everything below is a fixed value, but for NOT_IN_NAMES, which is our own; order is that of
the library.
"""

from __future__ import annotations

ROLE_PHRASES = (
    "ceo",
    "chief executive officer",
    "cfo",
    "chief financial officer",
    "coo",
    "chief operating officer",
    "president",
    "director",
    "chairman",
    "chairperson",
    "vice president",
    "treasurer",
    "secretary",
    "investor relations",
    "corporate secretary",
    "corporate communications",
    "corporate development",
    "corporate affairs",
    "corporate relations",
    "corporate contact",
    "contact person",
    "contact representative",
)
CONTACT_PHRASES = (
    "corporate office",
    "investor relations contact",
    "contact information",
    "contact us",
    "corporate contacts?",
)
MANAGEMENT_PHRASES = (
    "board of directors",
    "executive team",
    "management team",
    "leadership team",
    "senior management",
    "officers",
    "directors",
)
ROLE_STANDARDS = (
    ("[Cc][Ee][Oo]", "Chief Executive Officer"),
    ("[Cc][Ff][Oo]", "Chief Financial Officer"),
    ("[Cc][Oo][Oo]", "Chief Operating Officer"),
    ("[Vv][Pp]", "Vice President"),
    ("[Ii][Rr]", "Investor Relations"),
    ("[Dd]irector", "Director"),
    ("[Pp]resident", "President"),
    ("[Cc]hairman", "Chairman"),
    ("[Cc]hairperson", "Chairman"),
    ("[Tt]reasurer", "Treasurer"),
    ("[Ss]ecretary", "Secretary"),
)
EXECUTIVE_ROLES = (
    "Chief Executive Officer",
    "Chief Operating Officer",
    "President",
    "Vice President",
    "Corporate Secretary",
    "Chief Financial Officer",
)
BOARD_ROLES = ("Director", "Chairman", "Board Member")
CHIEF_EXECUTIVE = "Chief Executive Officer"
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE_PATTERN = r"(?:\+\d{1,2}\s?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}"
EXCLUDED_BY_MATCHER = (
    "press-release", "news", "blog", "announcement",
    "news-room", "press-releases", "projects",
)
EXCLUDED_BY_READER = (
    "press-release", "news", "blog", "announcement", "press", "update", "release",
    "media", "breaking", "newsroom", "reports", "financial-news", "corporate-news",
    "projects",
)
EXECUTIVE_PAGE_WORDS = ("team", "management", "leadership", "executive", "officer")
BOARD_PAGE_WORDS = ("board", "director", "chairman")
LINK_WORDS = (
    "management", "leadership", "team", "board", "directors",
    "governance", "about", "company", "corporate", "executives",
)
PAGE_KEYWORDS = ("chief", "officer", "director", "president", "leadership", "management")
NON_PERSON_WORDS = (
    "qualified person", "mine", "mines", "silver mine", "gold mine", "copper mine",
    "zinc mine", "ore", "ores", "mineral", "minerals", "mining", "quarry", "deposit",
    "resource", "resources", "exploration", "development", "corporation", "company",
    "inc", "llc", "limited", "group", "holdings", "press", "media", "news", "blog",
    "announcement", "report", "consultant", "advisor",
)
LEADING_TITLES = (
    "CEO", "CFO", "COO", "President", "Vice President", "VP", "Director", "Chairman",
    "Chair", "Chief", "Executive", "Manager", "Head", "Lead", "Superintendent",
    "Supervisor", "Coordinator", "Advisor", "Consultant", "Specialist",
)
NAME_AFTER_TITLE = r"[A-Z][a-z]+(?:\s+[A-Z][a-z]+)*"
CHIEF_TITLES = ("chief executive officer", "ceo")
CHAIR_TITLES = ("chairman", "chairman of the board")
# our own list: capitalised words of the rule that finds names
NOT_IN_NAMES = (
    "Chief", "Executive", "Financial", "Operating", "Officer", "Officers", "President",
    "Director", "Directors", "Chairman", "Chairperson", "Chair", "Vice", "Treasurer",
    "Secretary", "Investor", "Relations", "Corporate", "Communications", "Development",
    "Affairs", "Contact", "Contacts", "Person", "Representative", "Board", "Management",
    "Leadership", "Team", "Senior", "Office", "Information", "Our", "The", "Us", "And",
    "Company", "Corp", "Corporation", "Inc", "Ltd", "Limited", "Mr", "Mrs", "Ms", "Dr",
)
PROMPT_TEMPLATE = (
    "Analyze the following text about {company} and extract information about:\n"
    "1. Chief Executive Officer (CEO)\n"
    "2. Chairman of the Board\n"
    "\n"
    "Format the response as a JSON object with two arrays:\n"
    "- officers: Array of objects with 'name' and 'title' fields\n"
    "- board_members: Array of objects with 'name' and 'title' fields\n"
    "\n"
    "Only include the CEO and Chairman if they are explicitly mentioned.\n"
    "If a position is not found, return an empty array.\n"
    "\n"
    "Text to analyze:\n"
    "{text}\n"
    "\n"
    "Response format:\n"
    "{{\n"
    '    "officers": [\n'
    '        {{"name": "John Doe", "title": "Chief Executive Officer"}}\n'
    "    ],\n"
    '    "board_members": [\n'
    '        {{"name": "Jane Smith", "title": "Chairman of the Board"}}\n'
    "    ]\n"
    "}}"
)
