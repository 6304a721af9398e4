"""Fixed values that results depend on, stated plainly."""

# Texts that stand for a missing value. They differ by use and must not be merged.
PHONE_BLANKS = ("nan", "none", "null", "n/a")
PERSON_BLANKS = ("null", "none", "n/a", "na", "nil", "<null>")
MATCH_BLANKS = ("none", "null", "nan", "n/a", "na")
RETRIEVAL_BLANKS = ("na", "n/a", "none", "null", "nan", "-", "—", "tbd", "skip", "?", "0")

# Index files that a normalized URL leaves out.
INDEX_FILES = ("index.html", "index.htm", "index.php", "default.html", "default.htm", "index.asp", "default.asp")

# Path keywords of page types, in order of decision.
CONTACT_KEYWORDS = ("contact", "kontakt", "ansprechpartner")
IMPRINT_KEYWORDS = ("imprint", "impressum", "legal-notice", "legalnotice")
LEGAL_KEYWORDS = ("privacy", "datenschutz", "terms", "agb", "legal")
ABOUT_KEYWORDS = ("about", "about-us", "company", "profile", "mission", "vision", "team", "unternehmen", "profil", "ueber-uns", "uber-uns")
PRODUCT_KEYWORDS = ("products", "services", "solutions", "offerings", "platform", "features", "produkte", "leistungen", "lösungen", "angebot")
TARGET_LINK_KEYWORDS = ("about", "company", "services", "products", "solutions", "team", "mission", "projekte", "produkte", "leistungen", "lösungen", "unternehmen", "über-uns", "ueber-uns")
CRITICAL_KEYWORDS = ("about-us", "company-profile")
HIGH_KEYWORDS = ("services", "products", "solutions", "leistungen", "produkte", "lösungen")

# Paths whose links have no place in the crawl order.
EXCLUDED_PATHS = ("/media/", "/blog/", "/wp-content/", "/video/", "/hilfe-video/")

# Path and snippet keywords that raise a candidate's score.
CANDIDATE_PATHS = ("kontakt", "contact", "impressum", "legal", "about", "ueber", "über")
SNIPPET_KEYWORDS = ("tel", "telefon", "phone", "zentrale", "hotline", "call", "service", "vertrieb", "sales")

# Priority of a classification, then of a type; lower comes first. Others: 99 and 90.
CLASS_PRIORITY = {"Primary": 1, "Secondary": 2, "Support": 3, "Low Relevance": 4, "Non-Business": 5, "Unknown": 6}
TYPE_PRIORITY = {
    "Main Line": 1, "Mainline": 1, "Headquarters": 2, "Zentrale": 2, "Reception": 3, "Sales": 10, "Sales Department": 10,
    "Customer Service": 11, "Support": 12, "Support Hotline": 12, "Technical Support": 13, "Info-Hotline": 15,
    "RA-MICRO Online": 20, "Vertragsmanagement": 21, "Direct Dial": 25, "Mobile": 30, "Fax": 80, "Unknown": 99,
}

# What the type of a model's output adds to its score; other types nothing.
OUTPUT_TYPES = {
    "Direct Dial": 25, "Sales": 20, "Main Office": 15, "Support": 10, "Mobile": 5, "Hotline": 3, "HR": -5, "Billing": -5,
    "Other Department": 0, "Fax": -100, "Unknown": -10,
}

# Keywords of a person's role and their scores, first tier that holds one; any other role: 10, none: 0.
ROLE_TIERS = (
    (-50, ("janitor", "caretaker", "facility", "facilities", "hausmeister", "hauswart", "security", "wach", "pförtner", "porter", "cleaner", "reinigung", "cleaning", "driver", "fahrer", "chauffeur", "intern", "praktikant", "trainee", "azubi")),
    (100, ("ceo", "geschäftsführer", "geschaeftsfuehrer", "founder", "inhaber", "owner", "vorstand", "managing director")),
    (80, ("vertrieb", "sales", "business development", "account", "kundenberater", "key account")),
    (50, ("cto", "it", "technik", "engineering", "product", "produkt")),
    (30, ("hr", "personal", "recruiting")),
    (20, ("office", "sekretariat", "assist", "assistant", "rezeption", "reception", "front desk")),
)

# Outcome reasons and their fault categories.
FAULTS = {
    "Input_URL_Invalid": "Input Data Issue",
    "Input_URL_UnsupportedScheme": "Input Data Issue",
    "Scraping_AllAttemptsFailed_Network": "Website Issue",
    "Scraping_AllAttemptsFailed_AccessDenied": "Website Issue",
    "Scraping_ContentNotFound_AllAttempts": "Website Issue",
    "Scraping_Success_NoRelevantContentPagesFound": "Website Issue",
    "Canonical_Duplicate_SkippedProcessing": "Pipeline Logic/Configuration",
    "Canonical_NoRegexCandidatesFound": "Pipeline Logic/Configuration",
    "LLM_NoInput_NoRegexCandidates": "Pipeline Logic/Configuration",
    "LLM_Output_NoNumbersFound_AllAttempts": "LLM Issue",
    "LLM_Output_NumbersFound_NoneRelevant_AllAttempts": "LLM Issue",
    "LLM_Processing_Error_AllAttempts": "LLM Issue",
    "LLM_Reranker_NoOperationalCallList": "LLM Issue",
    "OperationalCallList_NotExported": "Pipeline Logic/Configuration",
    "DataConsolidation_Error_ForRow": "Pipeline Error",
    "Pipeline_Skipped_MaxRedirects_ForInputURL": "Website Issue",
    "Pipeline_Skipped_PreviouslyFailedInput": "Pipeline Logic/Configuration",
    "Unknown_Processing_Gap_NoContact": "Unknown",
}

# Short tokens that matching keeps, and words that it drops.
SHORT_TOKENS = ("ai", "bi", "crm", "erp", "hr", "it", "ot", "rfid", "seo", "sea", "api", "edi", "gps", "gnss", "plm", "eam", "mde", "cms", "b2b", "b2c", "iot")
STOPWORDS = (
    "and", "the", "for", "with", "from", "into", "that", "this", "these", "those", "their", "your", "they", "them",
    "already", "very", "more", "less", "also", "our", "ours", "you", "wir", "und", "der", "die", "das", "den", "dem",
    "des", "ein", "eine", "einer", "eines", "einem", "einen", "mit", "auf", "von", "für", "fur", "aus", "bei", "als",
    "auch", "noch", "durch", "uber", "über", "im", "in", "am", "an", "to", "of", "or", "is", "are", "be", "can", "will",
    "via", "company", "companies", "business", "businesses", "kunden", "customer", "customers", "solutions", "solution",
    "software", "services", "service", "plattform", "platform", "digital", "digitale", "technology", "technologies",
    "technologie", "innovative", "innovation", "innovativ", "system", "systems", "general", "specific", "focus",
    "fokus", "support", "offered", "offering", "offerings", "angebot", "angebote",
)

# Words of a match's reasons that say something of this pair, and words that would fit any.
SPECIFIC_MARKERS = (
    "gemeinsame zielgruppe", "zielgruppe", "buyer", "buying center", "shared audience", "shared target audience", "same audience",
    "gemeinsame ansprechpartner", "gemeinsame entscheider", "ähnliche produkte", "ähnliche services", "ähnliche produkt",
    "gemeinsame branche", "überschneidende marktsegmente", "ähnliche branchenanforderungen", "gemeinsame kunden",
    "anwendungsfälle", "workflow", "use cases", "einzelhändler", "law firms", "kanzlei", "marken", "logistik", "rfid",
    "e-commerce", "vertrieb",
)
GENERIC_MARKERS = (
    "digitale lösungen", "digitale software", "softwarelösungen", "digitalisierungslösungen", "plattformen", "technologie",
    "automatisierung", "effizienzsteigerung", "prozessoptimierung", "transparenz", "innovation", "innovativ",
    "künstliche intelligenz", "ki ",
)

# A partner's fields in its summary with their labels, and those that a matching model is told.
SUMMARY_FIELDS = (
    ("industry", "Industry"), ("usp", "USP"), ("services_products", "Services/Products"), ("target_audience", "Target Audience"),
    ("business_model", "Business Model"), ("company_size", "Company Size"), ("innovation_level", "Innovation Level"),
    ("geographic_reach", "Geographic Reach"), ("partnership_notes", "Partnership Notes"),
)
PAYLOAD_FIELDS = ("partner_id", "name", "rank", "target_audience", "services_products", "usp", "industry", "business_model", "match_candidate_summary")

# Columns that may describe a company, in order; columns of found numbers; words of pages that block.
FALLBACK_COLUMNS = ("Combined_Description", "Description", "Beschreibung", "categories", "products", "pdf_text")
RETRIEVED_COLUMNS = ("phonenumber_found", "top_number_1", "top_number_2", "top_number_3", "found_number", "bestpersoncontactnumber")
BLOCK_WORDS = ("access denied", "captcha", "cloudflare", "bot detection", "verify you are human", "enable javascript", "forbidden", "service unavailable", "temporarily unavailable")

# Lines of a contact page that are no contacts, headings that contacts follow, words that no role holds.
CONTACT_NOISE = (
    "mehr lesen", "download", "zum hallenplan", "produkte", "zum produkt", "keywords", "wir bieten", "branche", "über uns", "halles",
    "standnummer", "hersteller", "video", "kontaktinformation", "sprache", "kontakt per e-mail", "zum ausstellerverzeichnis", "hallenplan",
    "programm", "news", "newsletter", "impressum", "datenschutz", "agb",
)
CONTACT_HEADINGS = ("mitarbeiter", "ansprechpartner", "contacts", "kontakt", "team")
NO_ROLE = ("zum produkt", "download", "hallenplan")
NO_NAMES = ("e-mail senden", "email senden")

# What counts as a number, a labelled number, an address and a name in a line of a contact page.
CONTACT_PHONE = r"\+\d[\d\s()\-]+\d"
CONTACT_TEL = r"tel\.?\s*[:\-]?\s*(\+?\d[\d\s()\-]+\d)"
CONTACT_MAIL = r"[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}"
CONTACT_NAME = r"[A-ZÄÖÜ][a-zA-ZÄÖÜäöüß\-']+(\s+[A-ZÄÖÜ][a-zA-ZÄÖÜäöüß\-']+){1,3}"

# Weights of a shared tag by category, lower for generic tags; points off for unlike domains.
TAG_WEIGHTS = {"audience": 26, "workflow": 18, "domain": 14}
GENERIC_TAG_WEIGHTS = {"sme_buyers": 10, "workflow_automation": 8}
DOMAIN_PENALTIES = {
    "construction": {"document_software": 22, "healthcare": 26, "digital_agency": 16},
    "defense_simulation": {"document_software": 28, "digital_agency": 24, "healthcare": 28},
    "digital_agency": {"document_software": 18, "industrial_maintenance": 20, "logistics": 16, "mobility": 16},
    "ecommerce_retail": {"healthcare": 24, "industrial_maintenance": 20, "defense_simulation": 28},
    "mobility": {"document_software": 26, "digital_agency": 18, "healthcare": 24, "law_tax": 24},
    "procurement": {"healthcare": 20, "digital_agency": 14, "mobility": 14},
}

# Markers of cookie notices in attributes and in text lines; a strong one has a space.
COOKIE_ATTRIBUTES = ("cookie", "consent", "gdpr", "onetrust", "didomi", "cookiebot", "usercentrics", "cookie-banner", "cookiebanner", "cc-window", "cmplz", "privacy-center", "privacycenter")
COOKIE_MARKERS = (
    "this website uses cookies", "we use cookies", "cookie settings", "cookie preferences", "privacy preference",
    "consent preferences", "accept all", "reject all", "allow all", "manage preferences", "show details",
    "alle akzeptieren", "alle ablehnen", "cookie einstellungen", "datenschutzeinstellungen", "zustimmung verwalten",
    "consent", "cookie",
)
PHONE_OR_EMAIL = r"(?i)(\+\d[\d\s()\-/.]{5,}\d|[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,})"
