"""The word lists of the title and posting rules.

Each entry is a pattern over whole words of a normalised title (lower case, no accents,
punctuation read as blanks, ``&`` read as ``and``). Lists grow by appending entries.
"""

# --- security work -----------------------------------------------------------------

CORE = [
    "security", "infosec", "cyber[^ ]*", "threats?", "forensics?", "vulnerabilit(?:y|ies)",
    "penetration test(?:er|ing)?", "pen ?test(?:er|ing)?", "red team(?:er|ing)?", "purple team",
    "soc", "csirt", "dfir", "grc", "governance risk (?:and )?compliance",
    "identity (?:and )?access", "identity management", "iam", "devsecops", "secdevops",
    "dev sec", "ai safety", "ai red team", "ai alignment", "adversarial ml",
    "adversarial machine learning", "safeguards", "trustworthy ai", "responsible ai",
    "ai governance", "sec engineer(?:ing)?", "offensive", "exploitation", "malware",
    "reverse engineer(?:ing)?", "cno", "incident response", "appsec", "fortiappsec", "fortisiem",
    "siem", "detection engineer(?:ing)?", "computer network defense", "privacy and civil liberties",
    "cryptograph(?:y|ic)", "insider risk", "risk and security", "falcon complete", "anti tamper",
]

# Terms that leave no doubt, used where another word is ambiguous.
STRONG = [
    "cyber[^ ]*", "infosec", "information security", "vulnerabilit(?:y|ies)",
    "penetration test(?:er|ing)?", "pen ?test(?:er|ing)?", "red team(?:er|ing)?", "csirt", "dfir",
    "grc", "iam", "devsecops", "malware", "rmf", "siem", "appsec",
]

CYBER = ["cyber[^ ]*"]

OPS_GRC = [
    "mdr", "csoc", "snoc", "cssp", "secops", "edr", "xdr", "soar (?:engineer|analyst)", "isso",
    "isse", "rmf", "risk management framework", "emass", "stigs?", "acas", "pki",
    "(?:it|technology|information technology) (?:risk|audit|auditor|controls?)", "pci dss",
    "pci compliance", "identity governance", "ciam", "it ia", "information assurance",
    "attack sensing", "assessment and authorization", "a and a (?:engineer|analyst|specialist)",
]
THIRD_PARTY = ["third party risk", "vendor risk"]
THIRD_PARTY_QUALIFIER = ["cyber[^ ]*", "it", "technology", "security"]
CRITICAL_INFRA = ["critical infrastructure (?:protection|analysis)"]
CRITICAL_INFRA_ROLE = ["engineer", "developer", "scientist", "researcher"]

# --- the same words in another sense -------------------------------------------------

SEC_FILER = ["sec (?:reporting )?analyst"]
FINANCIAL_AUDIT = ["financial audit"]
MEDICAL = ["medical device(?:s)?", "medical", "clinical account specialist", "acas x"]
MEDICAL_TERM = ["mdr", "acas"]
MILITARY_THREAT = [
    "all source", "counter threat finance", "threats to aerospace", "mission support threat",
]
CHIP_SOC = [
    "soc (?:design|software|firmware|validation|verification|architecture|hardware|physical)",
]
CHIP_BESIDE = ["cpu", "gpu", "embedded"]

# --- products and teams --------------------------------------------------------------

PRODUCTS = [
    "splunk", "crowdstrike", "sailpoint", "okta", "zscaler", "qualys", "tenable", "rapid7",
    "fortinet", "fortigate", "(?:microsoft|azure) sentinel", "palo alto networks",
    "palo alto firewall", "pan os", "netskope", "saviynt", "ping identity", "forgerock", "firewall",
]
PRODUCT_ROLES = ["engineer", "administrator", "analyst", "developer", "architect", "consultant"]
OBSERVABILITY = ["observability"]
TEAM_TITLES = ["engineer", "engineering", "developer"]
TEAM_WORDS = [
    "identity", "authentication", "privacy", "trust and safety", "anti abuse", "fraud protection",
    "compromise", "network firewall", "anti tamper",
]

# --- cloud and solutions -------------------------------------------------------------

CLOUD = ["cloud", "aws", "azure", "gcp"]
CLOUD_ROLES = [
    "engineer", "engineering", "developer", "administrator", "architect", "technician",
]
CLOUD_OPS = [
    "cloud (?:support|operations) (?:associate|engineer|analyst|technician|specialist)",
    "cloud consultant",
]
CLOUD_LATER_ROLES = [
    "(?:devops|platform|infrastructure|site reliability|systems?) engineer", "sre",
]
CLOUD_INFRASTRUCTURE = ["oracle cloud infrastructure"]
CLOUD_OUT = [
    "scrum master", "business analyst", "project", "program manager", "product manager", "partner",
    "marketing", "finops", "cloud cost", "cloud financial", "data cent(?:er|re)", "hardware",
    "point clouds?", "(?:saint|st) cloud", "salesforce", "service cloud", "sales cloud",
    "oracle cloud", "hcm", "erp", "crm", "sap", "workday", "servicenow", "tableau", "genesys",
]
SOLUTIONS = [
    "solutions? architect(?:ure)?", "solutions? engineer(?:ing)?", "solutions? consult(?:ant|ing)",
]
SOLUTIONS_OUT = ["partner", "business", "project", "customer solutions? engineer"]
SALES_ENGINEER = ["(?:sales|presales|pre sales) engineer(?:ing)?"]
TECHNOLOGY = [
    "cloud", "software", "saas", "security", "it", "network", "data", "ai", "platform",
    "cyber[^ ]*",
]

# --- weak nouns ----------------------------------------------------------------------

WEAK_NOUN = [
    "security (?:specialist|technician|associate|assistant|coordinator|investigator|operator)",
    "(?:specialist|technician|assistant|coordinator|investigator|operator)"
    "(?: [0-9]| i| ii)? security",
]
SECOND_TERM = [
    "cyber[^ ]*", "information", "it", "network", "infosec", "cloud", "application", "data",
    "product", "systems?", "computer",
]
OFFICER = ["security officer"]
OFFICER_OK = [
    "information systems? security officer", "is security officer", "information security",
    "cyber[^ ]*", "isso",
]
SOC_ONE = ["soc 1"]
SOC_TWO = ["soc 2"]
SOC_SERVICES = ["soc services"]
ASSURANCE = ["assurance"]
FORENSIC = ["forensics?"]
LAB = [
    "lab", "laboratory", "chemistry", "toxicology", "dna", "biology", "healthcare", "coder",
]
DIGITAL = ["digital", "computer", "cyber[^ ]*", "mobile", "network", "malware"]

# --- security companies --------------------------------------------------------------

TECHNICAL = [
    "engineer", "engineering", "developer", "software", "devops", "sre", "researcher", "scientist",
    "analyst", "infrastructure", "platform", "backend", "back end", "frontend", "front end",
    "full ?stack", "machine learning", "detection", "architect",
    "(?:solutions?|domain|services|technical|resident) consultant",
]
SOFT_TECHNICAL = ["analyst", "researcher", "research"]
HARD_TECHNICAL = [
    "engineer", "engineering", "developer", "software", "devops", "sre", "scientist",
    "infrastructure", "platform", "backend", "back end", "frontend", "front end", "full ?stack",
    "machine learning", "detection", "architect",
]
BUSINESS_FUNCTION = [
    "business", "legal", "pricing", "operations", "market", "competitive intelligence", "sales",
    "revenue", "finance", "financial", "ux", "user research(?:er)?", "it support", "help ?desk",
    "it analyst",
]

# --- level ---------------------------------------------------------------------------

SEASON = "(?:spring|summer|fall|autumn|winter)"
YEAR = "20[0-9][0-9]"
INTERN = [
    "interns?", "internships?", "co ops?", "coop", "summer analyst", "summer associate",
    "student trainee",
]
SEASON_YEAR = [f"{SEASON} {YEAR}", f"{YEAR} {SEASON}"]
ASSOCIATE = ["associates?"]
NEWGRAD = [
    "new grads?", "new graduates?", "new college grad(?:uate)?s?",
    "(?:university|college) grad(?:uate)?s?", "graduates?", "rotational", "early talent",
    "(?:development|analyst|pathways|leadership|new professionals) program", "early in profession",
    YEAR,
]
PROGRAM_STAFF = ["development program specialist"]
EARLY = [
    "junior", "jr", "associate", "entry level", "early careers?", "apprentice(?:ship)?", "trainee",
    "residency", "fellowship", "(?:tier|level) (?:1|2|i|ii)", "l1", "l2", "engr asc", "asc",
]
EARLY_WORD = [
    "junior", "jr", "associate", "entry level", "early careers?", "apprentice(?:ship)?", "trainee",
    "residency", "fellowship", "engr asc", "asc",
]
DATED = ["residency", "fellowship"]
JOB_NOUN = (
    "(?:analyst|engineer|developer|administrator|admin|specialist|consultant|scientist|researcher|"
    "technician|operator|investigator|officer|architect|assessor|examiner|auditor|handler|isso|"
    "isse|tester|responder|associate|programmer|staff)"
)
NUMERAL = [f"{JOB_NOUN} (?:i|ii|1|2)"]
HIGH = [f"{JOB_NOUN} (?:iii|iv|3|4)", "(?:tier|level) (?:3|4|iii|iv)", "l3", "l4", "iii", "iv"]
SPAN = [
    "(?:i|ii) (?:or |and |to )?(?:iii|iv)", "(?:i|ii) ii (?:or |and |to )?(?:iii|iv)",
    f"(?:{JOB_NOUN}|tier|level) (?:1|2) (?:or |and |to )?(?:3|4)",
    f"(?:{JOB_NOUN}|tier|level) 1 2 (?:or |and |to )?(?:3|4)",
    "(?:associate|junior|jr|entry level) (?:or |and |to )?(?:mid|mid level|mid career|experienced)",
    "(?:mid|mid level|mid career|experienced) (?:or |and |to )?(?:associate|junior|jr|entry level)",
]

# --- always out ----------------------------------------------------------------------

NOT_A_RANK = [
    "member of (?:the )?technical staff", "associate staff",
    "office of the chief information security officer",
]
SENIOR = [
    "senior", "sr", "snr", "staff", "principal", "lead", "manager", "director", "vp", "avp",
    "head of", "chief", "distinguished", "fellow", "executive", "expert", "sme", "supervisor",
    "leader", "managing consultant", "associate consult partner", "issm",
]
ASSOCIATE_PARTNER = ["associate partner"]
ASSOCIATE_PARTNER_OK = ["associate partner (?:[a-z]+ )?(?:engineer|architect)"]
PHYSICAL = [
    "security guard", "physical security", "video security", "industrial security",
    "personnel security", "executive protection", "transportation security",
    "protective services", "security forces", "security badging", "electronic security",
    "workplace violence", "protective intelligence",
]
GUARD_CENTER = ["gsoc", "global security operations"]
INFO_OR_CYBER = ["cyber[^ ]*", "information security"]
OTHER_SECURITY = [
    "(?:social|food|energy|border|homeland|national|campus|event|regional|global|facility) security",
    "fire and security", "security cooperation", "security resiliency center",
    "securit(?:y|ies) (?:settlements?|and derivatives|master|pricing|valuation|lending)",
]
CORPORATE_SECURITY = ["corporate security"]
CORPORATE_ENGINEER = ["corporate security engineer"]
SALES = ["sales"]
BUSINESS = [
    "account (?:executive|manager)", "marketing", "recruiters?", "talent acquisition",
    "customer success", "business development", "equity research", "underwriters?",
    "cyber (?:insurance )?claims?", "accounting", "model risk", "sox", "attorneys?", "counsel",
    "paralegals?", "(?:administrative|executive) assistant", "facilities",
]
INTERNAL_AUDIT = ["internal audit"]
TECH_AUDIT = ["(?:it|technology) audit", "cyber[^ ]*"]
UNDERWRITING = ["underwriting"]
UNDERWRITING_OK = [
    "engineer", "developer", "architect", "administrator", "sre", "devops", "security analyst",
    "(?:it|information|network|application|cloud|product|data) security",
]
SUPPORT_FUNCTION = [
    "finance", "treasury", "revenue", "billing", "human resources", "payroll", "procurement",
    "supply chain", "customer support", "recruiting", "workplace",
]
HARDWARE = [
    "asic", "soc (?:design|verification)", "chip design",
    "(?:mechanical|electrical|chemical|industrial|civil|manufacturing|process)"
    "(?: (?:design|test|hardware|development|optimization))? engineer(?:ing)?",
]
SILICON = ["silicon"]
PLACEHOLDER = ["talent (?:community|network)", "general interest", "hackathon"]
CLOSED_PROGRAM = [
    "intern conversion", "return offer", "return(?:ing)? interns?", f"{YEAR} interns? only",
    "former interns?", "skillbridge", "military (?:fellowship|development program|spouses?)",
    "veterans? (?:transition|integration)", "returnship", "hiring event",
]
PLANT = ["asset protection", "security licen[cs]e", "[0-9]+ (?:an|per) hour"]
# A pay rate in a title as written: a currency mark before an hour, or a number over an hour.
PAY_RATE = r"(?i)(?:[$€£]|\busd) ?[0-9][0-9.,]*[^a-z]*(?:hr|hour)|[0-9] ?/ ?(?:hr|hour)"

# --- level from the posting ----------------------------------------------------------

AI_SECURITY = [
    "ai (?:security|safety|red team|alignment)", "adversarial (?:ml|machine learning)",
    "safeguards", "responsible ai", "trustworthy ai",
]
OWN_WORDS = [
    "security (?:analyst|engineer|developer|tester|responder|researcher|scientist|architect|hunter)",
]
PRACTITIONER = [
    "analyst", "engineer", "developer", "researcher", "consultant", "administrator", "operator",
    "specialist", "officer", "auditor", "tester", "scientist",
]
HIGHER_RANK = [
    "journeyman", "established", "experienced", "intermediate", "advanced", "expert",
    "professional", "mid", "mid level", "mid career", "iii", "iv", "multiple levels",
]
SIDE_JOB = [
    "sales", "presales", "pre sales", "policy", "liaison", "program", "instructor", "writer",
    "targeting", "all source",
]

# --- categories, narrow to general ---------------------------------------------------

CATEGORY_TERMS = {
    "AI Security & Safety": [
        "ai (?:security|safety|red team|alignment|governance)", "responsible ai", "trustworthy ai",
        "adversarial (?:ml|machine learning)", "safeguards",
    ],
    "Offensive Security": [
        "offensive", "red team(?:er|ing)?", "purple team", "penetration test(?:er|ing)?",
        "pen ?test(?:er|ing)?", "exploit(?:s|ation)?", "cno", "vulnerability research(?:er)?",
    ],
    "SOC & Detection": [
        "soc", "csoc", "snoc", "cssp", "security operations", "secops",
        "cyber(?:security)? operations", "defensive cyber", "cyberspace operations analyst",
        "detection", "falcon complete", "(?:forti)?siem", "triage", "network defense",
        "cyber defense", "incident response", "s?c?sirt", "mdr", "edr", "xdr", "soar",
        "threat hunt(?:er|ing)?", "attack sensing",
    ],
    "Threat Intelligence": ["(?:cyber|threat) intelligence", "threat intel"],
    "Forensics & IR": ["forensics?", "dfir", "malware", "reverse engineer(?:ing)?"],
    "AppSec & ProdSec": [
        "(?:application|product|software) security", "(?:forti)?appsec", "devsecops", "secdevops",
    ],
    "Cloud & Infra Security": [
        "(?:cloud|network|infrastructure|platform|systems) security", "pki",
    ],
    "Identity & IAM": ["identity", "iam", "ciam", "sailpoint", "okta", "saviynt", "forgerock"],
    "GRC & Risk": [
        "grc", "governance", "risk", "compliance", "audit(?:or)?", "isso", "rmf", "emass",
        "stigs?", "assurance", "policy", "pci", "controls?", "it ia",
    ],
}

# --- places --------------------------------------------------------------------------

# Towns whose name alone reads as a place abroad; they need a state code.
FOREIGN_TWINS = [
    "Hamburg", "Vienna", "London", "Paris", "Dublin", "Berlin", "Rome", "Athens", "Madrid",
    "Toronto", "Moscow", "Warsaw", "Lisbon", "Delhi", "Milan", "Naples", "Geneva", "Manchester",
]

# Countries and regions a title or a remote scope may name.
# Countries and regions that a title can end with. Names that are also a state, a town or a given
# name of the United States (Georgia, Jordan, Chad, Lebanon, Cuba, Peru) are left to the location.
ABROAD = [
    "uk", "united kingdom", "england", "scotland", "wales", "ireland", "germany", "france", "spain",
    "portugal", "italy", "netherlands", "belgium", "luxembourg", "switzerland", "austria", "denmark",
    "sweden", "norway", "finland", "iceland", "poland", "czechia", "czech republic", "slovakia",
    "slovenia", "hungary", "romania", "bulgaria", "greece", "cyprus", "malta", "croatia", "serbia",
    "bosnia", "albania", "estonia", "latvia", "lithuania", "ukraine", "moldova", "belarus", "russia",
    "turkey", "turkiye", "israel", "saudi arabia", "uae", "united arab emirates", "qatar", "kuwait",
    "bahrain", "oman", "egypt", "morocco", "tunisia", "algeria", "kenya", "nigeria", "ghana",
    "ethiopia", "south africa", "india", "pakistan", "bangladesh", "sri lanka", "nepal", "china",
    "hong kong", "taiwan", "japan", "korea", "singapore", "malaysia", "indonesia", "thailand",
    "vietnam", "philippines", "kazakhstan", "uzbekistan", "australia", "new zealand", "canada",
    "costa rica", "guatemala", "el salvador", "honduras", "nicaragua", "dominican republic",
    "jamaica", "colombia", "ecuador", "bolivia", "chile", "argentina", "uruguay", "paraguay",
    "brazil", "venezuela", "mexico", "europe", "emea", "apac", "latam",
]
ABROAD_TITLE = f" located (?:at|in) .* (?:{'|'.join(ABROAD)}) "
# Cities abroad that a title can end with.
CITIES_ABROAD = [
    "cardiff", "leeds", "liverpool", "sheffield", "galway", "lyon", "toulouse", "grenoble", "munich", "frankfurt",
    "cologne", "dusseldorf", "zurich", "basel", "lausanne", "the hague", "eindhoven", "utrecht", "antwerp", "barcelona",
    "porto", "turin", "krakow", "wroclaw", "gdansk", "prague", "brno", "budapest", "bucharest", "cluj", "sofia",
    "zagreb", "ljubljana", "bratislava", "stockholm", "gothenburg", "malmo", "oslo", "copenhagen", "helsinki",
    "tallinn", "riga", "vilnius", "kyiv", "lviv", "istanbul", "ankara", "tel aviv", "herzliya", "haifa", "dubai",
    "abu dhabi", "riyadh", "doha", "casablanca", "nairobi", "lagos", "accra", "johannesburg", "cape town", "pretoria",
    "bengaluru", "bangalore", "hyderabad", "mumbai", "pune", "chennai", "new delhi", "gurgaon", "gurugram", "noida",
    "kolkata", "ahmedabad", "kochi", "karachi", "lahore", "dhaka", "colombo", "kuala lumpur", "jakarta", "cebu",
    "bangkok", "hanoi", "ho chi minh city", "seoul", "tokyo", "osaka", "beijing", "shanghai", "shenzhen", "taipei",
    "sydney", "brisbane", "canberra", "auckland", "montreal", "calgary", "edmonton", "winnipeg", "mississauga",
    "quebec", "mexico city", "guadalajara", "monterrey", "queretaro", "tijuana", "bogota", "medellin", "sao paulo",
    "rio de janeiro", "buenos aires", "montevideo",
]
# Cities abroad whose name is also a town's in the United States; with that town in the location they are at home.
CITY_TWINS = [t.lower() for t in FOREIGN_TWINS] + [
    "birmingham", "edinburgh", "glasgow", "belfast", "bristol", "cambridge", "oxford", "cork", "stuttgart", "amsterdam",
    "rotterdam", "brussels", "valencia", "belgrade", "cairo", "perth", "melbourne", "wellington", "vancouver",
    "ottawa", "waterloo", "manila", "lima", "santiago", "st petersburg",
]
# Names in the United States that end like a place abroad.
HOME_NAMES = ["new england", "new london", "new berlin", "new britain", "new rome", "new madrid", "east liverpool"]
# Words after a place that say how, not where, the work is done.
PLACE_TAILS = ["hybrid", "remote", "onsite", "site", "office", "hub", "based", "area", "metro"]
PLACE_TAIL = f"(?: on)?(?: (?:{'|'.join(PLACE_TAILS)}))+ $"
# Words of the longest of these names.
PLACE_WORDS = 4
