"""Fixed values.

Everything in this module is a value list that results depend on: word lists, ordered
rule tables, labels, URL shapes. Order matters wherever a table is used first-match-wins.
"""

# --- fixed values: careers-page discovery -------------------------------------------

CAREER_PATHS = [
    "/careers", "/jobs", "/join-us", "/join", "/opportunities",
    "/openings", "/vacancies", "/work-with-us",
    "/about/careers", "/company/careers", "/en/careers",
]
CAREER_PATH_VARIANTS = [
    ("career", "careers"),
    ("job", "jobs"),
    ("opening", "openings"),
    ("vacancy", "vacancies"),
]
PLATFORM_HOSTS = [
    "greenhouse.io", "boards.greenhouse.io", "lever.co", "workable.com",
    "ashbyhq.com", "myworkdayjobs.com", "icims.com", "recruitee.com",
    "smartrecruiters.com", "teamtailor.com", "bamboohr.com", "naukri.com",
    "darwinbox.in", "keka.com", "wellfound.com", "zohorecruit.com",
    "personio.com", "jobs.jobvite.com", "applytojob.com",
]
JOB_LINK_WORDS = [
    "career", "job", "join-us", "joinus",
    "work-with-us", "opportunities", "openings", "vacancies",
]
PAGE_HINTS = [
    "openings", "positions", "roles", "departments", "location",
    "apply", "search jobs", "job listings", "join our team",
]

# --- fixed values: hiring platforms, in match order ---------------------------------
# (name, host substrings, pattern whose groups fill the address, address)

PLATFORM_RULES = [
    ("iCIMS", ["icims.com"], r"https?://([^.]+)\.icims\.com", "https://{}.icims.com/jobs/"),
    ("SuccessFactors", ["successfactors.com", "successfactors.eu", "sapsf.com"],
     r"(?:successfactors\.(?:com|eu)|sapsf\.com)/career\?(?:.*&)?company=([^&]+)",
     "https://career5.successfactors.com/career?company={}"),
    ("Taleo", ["taleo.net"], r"https?://([^.]+)\.taleo\.net",
     "https://{}.taleo.net/careersection/2/jobsearch.ftl"),
    ("Freshteam", ["freshteam.com"], r"https?://([^.]+)\.freshteam\.com", "https://{}.freshteam.com/jobs"),
    ("Recruiterbox", ["recruiterbox.com"], r"recruiterbox\.com/([^/]+)", "https://{}.recruiterbox.com/jobs"),
    ("JazzHR", ["applytojob.com"], r"https?://([^.]+)\.applytojob\.com", "https://{}.applytojob.com/apply"),
    ("Breezy HR", ["breezy.hr"], r"https?://([^.]+)\.breezy\.hr", "https://{}.breezy.hr/"),
    ("FactoHR", ["factohr.com"], r"factohr\.com/([^/]+)", "https://{}.factohr.com/careers"),
    ("Ashby", ["ashbyhq.com", "jobs.ashbyhq.com"], r"ashbyhq\.com/([^/]+)", "https://jobs.ashbyhq.com/{}"),
    ("RecruitCRM", ["recruitcrm.io"], r"recruitcrm\.io/(?:apply/\S+|([^/]+))", "https://recruitcrm.io/{}"),
    ("Rippling", ["rippling.com"], r"rippling\.com/(?:careers/|)([^/?#]+)", "https://ats.rippling.com/{}/jobs"),
    ("PyjamaHR", ["pyjamahr.com"], r"pyjamahr\.com/careers\?(?:.*&)?company=([^&]+)",
     "https://app.pyjamahr.com/careers?company={}"),
    ("ZipRecruiter", ["ziprecruiter.com"], r"ziprecruiter\.com/([^/]+)",
     "https://www.ziprecruiter.com/candidate/search?company={}"),
    ("Lever", ["jobs.lever.co", "lever.co"], r"lever\.co/([^/?#]+)", "https://jobs.lever.co/{}"),
    ("Zoho Recruit", ["zohorecruit.com", "zohorecruit.in", "zohorecruit.eu"],
     r"https?://([^.]+)\.zohorecruit\.(com|in|eu)", "https://{}.zohorecruit.{}/jobs/careers"),
    ("Keka", ["keka.com"], r"https?://([^.]+)\.keka\.com", "https://{}.keka.com/careers/"),
    ("Workable", ["apply.workable.com"], r"workable\.com/([^/?#]+)", "https://apply.workable.com/{}/"),
    ("Workday", ["myworkdayjobs.com", "myworkdaysite.com"],
     r"https?://(?:([^.]+)\.myworkdayjobs\.com|wd\d+\.myworkdaysite\.com/recruiting/([^/?#]+))",
     "https://{}.myworkdayjobs.com/en-US/Careers"),
    ("Darwinbox", ["darwinbox.in"], r"https?://([^.]+)\.darwinbox\.in",
     "https://{}.darwinbox.in/ms/candidatev2/main/careers/allJobs"),
    ("Greenhouse", ["greenhouse.io", "boards.greenhouse.io"], r"greenhouse\.io/([^/?#]+)",
     "https://boards.greenhouse.io/{}"),
    ("Teamtailor", ["teamtailor.com"], r"https?://([^.]+)\.teamtailor\.com", "https://{}.teamtailor.com/jobs"),
    ("Jobvite", ["jobvite.com"], r"jobvite\.com/([^/?#]+)", "https://jobs.jobvite.com/{}/jobs"),
    ("SmartRecruiters", ["smartrecruiters.com", "jobs.smartrecruiters.com"],
     r"smartrecruiters\.com/([^/?#]+)", "https://careers.smartrecruiters.com/{}"),
    ("BambooHR", ["bamboohr.com"], r"https?://([^.]+)\.bamboohr\.com", "https://{}.bamboohr.com/careers"),
]

# --- fixed values: title gate --------------------------------------------------------

TITLE_WORDS = [
    "Sustainability", "Sustainable", "ESG", "Environmental Social Governance",
    "CSR", "Corporate Social Responsibility", "Climate", "Climate Change", "Carbon",
    "Decarbonization", "Decarbonisation", "GHG", "Greenhouse", "Emissions", "Net Zero",
    "Mitigation", "Resilience", "Environmental", "Environment", "Ecology", "Ecologist",
    "Biodiversity", "Conservation", "Habitat", "Restoration", "EHS", "Environment Health Safety",
    "HSE", "Health Safety Environment", "HSSE", "Health Safety Security Environment",
    "Safety", "Occupational", "Hygiene", "Industrial Hygiene", "Process Safety",
    "Water", "Wastewater", "Stormwater", "Hydrology", "Hydrogeology", "Groundwater",
    "Renewable", "Solar", "Wind", "Battery", "BESS", "Battery Energy Storage System",
    "Energy Transition", "Waste", "Recycling", "Circular", "Circular Economy", "Reuse", "Landfill",
    "Compliance", "Regulatory", "Disclosure", "Governance", "GRI", "Global Reporting Initiative",
    "SASB", "Sustainability Accounting Standards Board", "TCFD",
    "Task Force on Climate related Financial Disclosures", "CDP", "Carbon Disclosure Project",
    "Remediation", "Permitting", "Contaminated", "Soil", "Environmental Impact Assessment",
    "Due Diligence", "Hazard", "Hazardous", "GIS", "Clean Energy", "Energy Storage",
]

# --- fixed values: department rules, first match wins --------------------------------

GENERAL_DEPARTMENT_DEFAULT = "Administration & Operations Support"
GENERAL_DEPARTMENT_RULES = [
    (r"\b(qa|qc|quality\s+(?:analyst|assurance|control|engineer)|test\s+engineer|testing|validation|quality\s+&.*business\s+excellence)\b", "Quality Assurance & Testing"),
    (r"\b(data\s+scientist|machine\s+learning|ml\s+(?:engineer|researcher)|ai\s+(?:engineer|researcher)|artificial\s+intelligence|computer\s+vision|image\s+(?:processing|analyst|analysis)|imagery\s+analyst|data\s+analyst|business\s+analyst|investment\s+analyst|valuation\s+analyst)\b", "Data Science & AI/ML"),
    (r"\b(space|satellite|mission\s+(?:operations|planning|system|design|engineer)|geospatial|flight\s+software|ground\s+software|avionics|spaceborne|mission\s+design|satellite\s+constellations)\b", "Space & Satellite Systems"),
    (r"\b(solar|photovoltaic|pv|renewable\s+energy|rooftop|o&m\s+engineer.*solar|wind\s+&.*solar)\b", "Renewable Energy & Solar"),
    (r"\b(bess|battery|energy\s+storage|cell\s+engineer|cell\s+&.*algorithms)\b", "Energy Storage & Battery Systems"),
    (r"\b(ev\s+|electric\s+vehicle|charger|charging\s+infrastructure|powertrain|vehicle\s+integration)\b", "Electric Vehicles & Charging Infrastructure"),
    (r"\b(software\s+(?:engineer|developer)|backend|frontend|full\s+stack|devops|sde|python|node\.js|\.net|java|android|ios|flutter|react|angular|golang|sql|postgre|cloud|integration|mobile|ui\s+engineer|etl)\b", "Software Engineering"),
    (r"\b(hardware|electronics|pcb|embedded|firmware|power\s+electronics)\b", "Hardware & Electronics Engineering"),
    (r"\b(o&m|operations\s+and\s+maintenance|maintenance|field\s+service|asset\s+management)\b", "Energy Operations & Maintenance"),
    (r"\b(environmental|sustainability|climate|waste|ehs)\b", "Environmental & Sustainability"),
    (r"\b(power\s+system|substation|grid|electrical\s+system)\b", "Power Systems & Grid"),
    (r"\b(agri|agriculture|crop|agriculturist)\b", "Agriculture & AgriTech"),
    (r"\b(bim|cad|draftsman|structural\s+design|civil|mep)\b", "Green Building & Engineering"),
    (r"\b(engineer|technical|scada|commissioning|robotics)\b", "Engineering & Technical Solutions"),
    (r"\b(field\s+(?:engineer|technician)|installation|electrician)\b", "Field Operations & Installation"),
    (r"\b(it\s+support|network|system\s+admin|erp|sap)\b", "IT & Systems"),
    (r"\b(sales|business\s+development|account\s+manager)\b", "Sales & Business Development"),
    (r"\b(project\s+manager|program\s+manager|pmo)\b", "Project & Program Management"),
    (r"\b(product\s+manager|product\s+owner)\b", "Product Management"),
    (r"\b(marketing|seo|brand|content)\b", "Marketing & Communications"),
    (r"\b(customer\s+support|customer\s+success)\b", "Customer Success & Support"),
    (r"\b(operations|supply\s+chain|logistics|warehouse|procurement)\b", "Operations & Supply Chain"),
    (r"\b(finance|accounting|auditor|tax)\b", "Finance & Accounting"),
    (r"\b(hr|human\s+resources|talent|recruiter|trainer)\b", "Human Resources & Talent"),
    (r"\b(legal|compliance|risk|lawyer)\b", "Legal, Compliance & Risk"),
    (r"\b(designer|ui\/ux|graphic|creative)\b", "Design & Creative"),
    (r"\b(research|r&d|innovation|lab)\b", "Research & Development"),
    (r"\b(admin|office|executive\s+assistant)\b", "Administration & Operations Support"),
    (r"\b(intern|trainee|fresher)\b", "Internships & Early Career"),
    (r"\b(manager|director|head|vp|chief|lead)\b", "Executive, Management, & Leadership"),
]
GENERAL_CATEGORIES = [
    "Sales & Business Development", "Engineering & Technical Solutions",
    "Operations & Supply Chain", "Finance & Accounting",
    "Human Resources & Talent", "Marketing & Communications",
    "Customer Success & Support", "Project & Program Management",
    "Renewable Energy & Solar", "Energy Storage & Battery Systems",
    "Electric Vehicles & Charging Infrastructure",
    "Environmental & Sustainability", "Agriculture & AgriTech",
    "Green Building & Engineering", "Energy Operations & Maintenance",
    "Power Systems & Grid", "Executive, Management, & Leadership",
    "Administration & Operations Support", "Internships & Early Career",
    "Quality Assurance & Testing", "Legal, Compliance & Risk",
    "Design & Creative", "Field Operations & Installation",
    "Space & Satellite Systems", "Research & Development",
    "Software Engineering", "Data Science & AI/ML",
    "Product Management", "IT & Systems",
    "Hardware & Electronics Engineering",
]

GREEN_DEPARTMENT_DEFAULT = "Sustainability & ESG"
GREEN_DEPARTMENT_RULES = [
    (r"\b(ehs|hse|she|environmental\s+health|occupational\s+health|safety\s+(?:officer|engineer|manager)|health\s+and\s+safety)\b", "EHS / HSE (Environmental Health & Safety)"),
    (r"\b(reporting|gri|sasb|tcfd|csrd|esg\s+reporting|sustainability\s+reporting|audit|lca|life\s+cycle\s+assessment|esg\s+compliance)\b", "ESG Compliance & Sustainability Reporting"),
    (r"\b(climate\s+data|esg\s+data|esg\s+(?:analyst|analytics)|sustainability\s+(?:analyst|data)|climate\s+analytics|gis|geospatial)\b", "Climate Data & ESG Analytics"),
    (r"\b(solar|pv|photovoltaic|rooftop|distributed\s+energy|microgrid)\b", "Solar & Distributed Energy"),
    (r"\b(renewable|clean\s*tech|wind|geothermal|biomass|bess|battery\s+storage|ev\s+|electric\s+vehicle)\b", "Renewable Energy & Clean Tech"),
    (r"\b(climate\s+finance|impact\s+investing|green\s+bonds|esg\s+investing|sustainable\s+finance|investment\s+analyst)\b", "Climate Finance & Impact Investing"),
    (r"\b(supply\s+chain|procurement|logistics|scope\s+3|sustainable\s+sourcing)\b", "Sustainable Supply Chain"),
    (r"\b(green\s+building|leed|breeam|sustainable\s+infrastructure|civil\s+engineer|mep|energy\s+efficiency|hvac)\b", "Green Engineering & Sustainable Infrastructure"),
    (r"\b(water|wastewater|hydrology|hydrogeology|desalination|effluent)\b", "Water & Wastewater Management"),
    (r"\b(ecology|ecological|biodiversity|conservation|wildlife|forestry|marine\s+biology|zoology)\b", "Ecology & Biodiversity"),
    (r"\b(carbon|ghg|greenhouse\s+gas|net\s*zero|decarbonization|emissions|climate\s+action)\b", "Climate & Carbon Management"),
    (r"\b(education|skilling|training|capacity\s+building|climate\s+literacy|curriculum)\b", "Climate Education & Skilling"),
    (r"\b(waste\s+management|circular\s+economy|pollution|remediation|environmental\s+(?:scientist|consultant|manager|planner))\b", "Environmental Management"),
    (r"\b(sustainability|esg|environmental\s+social|corporate\s+responsibility|csr)\b", "Sustainability & ESG"),
]
GREEN_CATEGORIES = [
    "Sustainability & ESG",
    "Climate & Carbon Management",
    "Renewable Energy & Clean Tech",
    "Environmental Management",
    "EHS / HSE (Environmental Health & Safety)",
    "Ecology & Biodiversity",
    "Water & Wastewater Management",
    "Climate Data & ESG Analytics",
    "ESG Compliance & Sustainability Reporting",
    "Green Engineering & Sustainable Infrastructure",
    "Solar & Distributed Energy",
    "Climate Finance & Impact Investing",
    "Sustainable Supply Chain",
    "Climate Education & Skilling",
]

LONG_DEPARTMENT_DEFAULT = "Other"
LONG_DEPARTMENT_RULES = [
    (r"\b(fpga|embedded|vlsi|hardware|circuit|chip|asic|board)\b", "Hardware"),
    (r"\b(java|python|developer|coder|software|frontend|backend|fullstack)\b", "Software Development"),
    (r"\b(engineer|engineering)\b", "Engineering"),
    (r"\b(sales|bd|business development|pre[- ]?sales|marketing|specialist)\b", "Sales & Marketing"),
    (r"\b(hr|human resources|talent|recruitment)\b", "Human Resources"),
    (r"\b(finance|accounting|audit|tax|treasury)\b", "Finance"),
    (r"\b(solar|renewable)\b", "Solar"),
    (r"\b(wind)\b", "Wind Power"),
    (r"\b(healthcare|nurse|doctor|clinical)\b", "Healthcare"),
    (r"\b(pharma|biotech)\b", "Pharmaceutical & Biotechnology"),
    (r"\b(ops|operations|supply chain|logistics|procurement)\b", "Operations"),
    (r"\b(legal|law|compliance)\b", "Legal"),
    (r"\b(admin|office)\b", "Administration"),
    (r"\b(content|editor|journalist|writer)\b", "Content, Editorial & Journalism"),
    (r"\b(customer|support|success|service)\b", "Customer Success"),
]
LONG_DEPARTMENTS = [
    "Accounting & Taxation", "Administration", "Administration & Staff", "Advertising & Creative",
    "After Sales Service & Repair", "Airline Services", "Animation / Effects", "Architecture & Interior Design",
    "Artists", "Assessment / Advisory", "Audit & Control", "Aviation Engineering", "Back Office",
    "Banking Operations", "BD / Pre Sales", "Beauty & Personal Care", "BFSI, Investments & Trading", "Business",
    "Business Intelligence & Analytics", "Business Process Quality", "Category Management & Operations",
    "Climate Change", "Community Health & Safety", "Compensation & Benefits", "Conservation",
    "Construction / Manufacturing", "Construction Engineering", "Content Management- Print / Online / Electronic",
    "Content, Editorial & Journalism", "Corporate Affairs", "Corporate Communication", "Corporate Training",
    "CSR & Sustainability", "Customer Success", "Customer Success, Service & Operations",
    "Data Science & Analytics", "Data Science & Machine Learning", "DBA / Data warehousing", "DevOps",
    "Digital Marketing", "Direction", "Downstream", "Ecology", "eCommerce Operations", "Editing",
    "Educators & Teachers", "EHS", "Employee Relations", "Energy Efficiency", "Engineering",
    "Engineering & Manufacturing", "Enterprise & B2B Sales", "Environment Health and Safety", "Environmental",
    "F&B Service", "Facility Management", "Farming", "Fashion & Accessories", "Finance", "Finance & Accounting",
    "Food, Beverage & Hospitality", "Front Office & Guest Services", "General Insurance", "Geologist", "Hardware",
    "Hardware and Networks", "Health & Fitness", "Healthcare & Life Sciences", "Housekeeping & Laundry",
    "HR Business Advisory", "HR Operations", "Human Resources", "HVAC", "Imaging & Diagnostics",
    "Import & Export", "Investment Banking, Private Equity & VC", "IT & Information Security", "IT Consulting",
    "IT Infrastructure Services", "IT Network", "IT Security", "IT Support", "Journalism",
    "Kitchen / F&B Production", "Language Teacher", "LEED", "Legal & Regulatory", "Legal Operations", "Lending",
    "Life Skills / ECA Teacher", "Management", "Management Consulting", "Market Research & Insights", "Marketing",
    "Marketing and Communication", "Media Production & Entertainment", "Merchandising & Planning",
    "Merchandising, Retail & eCommerce", "Mining", "Naturalist", "Nursing", "Occupational Health & Safety",
    "Operations", "Operations / Strategy", "Operations Support", "Operations, Maintenance & Support",
    "Other Consulting", "Other Hospital Staff", "Payroll & Transactions", "Pharmaceutical & Biotechnology",
    "Port & Maritime Operations", "Power Generation", "Power Supply and Distribution",
    "Preschool & Primary Education", "Procurement & Purchase", "Procurement & Supply Chain",
    "Product Management", "Product Management - Technology", "Production", "Production & Manufacturing",
    "Program / Project Management", "Quality Assurance", "Quality Assurance and Testing",
    "Recruitment & Talent Acquisition", "Recruitment Marketing & Branding", "Recycling", "Renewable Energy",
    "Research & Development", "Retail & B2C Sales", "Retail Store Operations", "Risk Management & Compliance",
    "Sales Support & Operations", "SCM & Logistics", "Security / Fraud", "Security Officer", "Security Services",
    "Service Delivery", "Shipping & Maritime", "Shipping Engineering & Technical", "Smart Grid",
    "Social & Public Service", "Software Development", "Solar", "Sound / Light / Technical Support",
    "Sports Staff and Management", "Sports, Fitness & Personal Care", "Stores & Material Management",
    "Strategic & Top Management", "Strategic Management", "Subject / Specialization Teacher", "Surveying",
    "Sustainability", "Sustainable Ag.", "Teaching & Training", "Technology / IT", "Telecom", "Top Management",
    "Tourism Services", "Trading, Asset & Wealth Management", "Treasury & Forex", "UI / UX", "Water",
    "Weatherization", "Wildlife", "Wind Power",
]

# --- fixed values: job types ----------------------------------------------------------

JOB_TYPES = {
    "full time": "Full time",
    "full-time": "Full time",
    "part time": "Part time",
    "part-time": "Part time",
    "contract": "Contract",
    "internship": "Internship",
    "temporary": "Temporary",
    "freelance": "Freelance",
}
JOB_TYPES_TITLED = {
    "full time": "Full Time",
    "full-time": "Full Time",
    "part time": "Part Time",
    "part-time": "Part Time",
    "contract": "Contract",
    "temporary": "Temporary",
    "internship": "Internship",
    "freelance": "Freelance",
}
CONTRACTOR_WORDS = ["freelance", "contract", "part", "fraction", "training", "part-time"]

# --- fixed values: description sections ----------------------------------------------

SECTION_HEADINGS = {
    "ROLE": ["ROLE", "RESPONSIBILITIES"],
    "REQUIREMENTS": ["REQUIREMENTS", "QUALIFICATIONS"],
    "BENEFITS": ["BENEFITS", "PERKS"],
}
PLACEHOLDERS = [
    "not mentioned", "not provided", "not listed", "not specified",
    "no specific", "no particular", "no information", "none", "n/a", "(", ")",
]

# --- fixed values: status texts and sentinels ------------------------------------------

EXISTS, SCANNED, NO_CAREERS = "Already Exist", "Scanned", "No Career Page"
PLATFORM_FOUND, PLATFORM_MISSING = "scanned", "not ats found"
MISSING_TEXT = "NA"
FAILED = "FAILED_TO_LOAD"
UNKNOWN_COMPANY = "Unknown"

# --- fixed values: anchors that are never postings -------------------------------------

ANCHOR_NOISE = ["visit website", "zoho recruit"]

# --- fixed values: place tokens for the physical-India gate ----------------------------

INDIA_PLACES = [
    "india", "bharat",
    "andhra pradesh", "arunachal pradesh", "assam", "bihar", "chhattisgarh", "goa", "gujarat", "haryana",
    "himachal pradesh", "jharkhand", "karnataka", "kerala", "madhya pradesh", "maharashtra", "manipur",
    "meghalaya", "mizoram", "nagaland", "odisha", "orissa", "punjab", "rajasthan", "sikkim", "tamil nadu",
    "telangana", "tripura", "uttar pradesh", "uttarakhand", "west bengal", "delhi", "new delhi", "ncr",
    "chandigarh", "puducherry", "pondicherry", "jammu", "kashmir", "ladakh",
    "mumbai", "bombay", "navi mumbai", "thane", "pune", "nagpur", "nashik", "aurangabad", "bengaluru",
    "bangalore", "mysuru", "mysore", "mangalore", "mangaluru", "hubli", "hyderabad", "secunderabad", "warangal",
    "visakhapatnam", "vizag", "vijayawada", "chennai", "madras", "coimbatore", "madurai", "tiruchirappalli",
    "salem tamil nadu", "kolkata", "calcutta", "howrah", "durgapur", "ahmedabad", "vadodara", "baroda", "surat",
    "rajkot", "gandhinagar", "jamnagar", "jaipur", "jodhpur", "udaipur", "kota", "lucknow", "kanpur", "noida",
    "greater noida", "ghaziabad", "agra", "varanasi", "prayagraj", "meerut", "gurgaon", "gurugram", "faridabad",
    "panipat", "ludhiana", "amritsar", "mohali", "dehradun", "haridwar", "shimla", "bhopal", "indore", "gwalior",
    "jabalpur", "raipur", "bilaspur", "ranchi", "jamshedpur", "dhanbad", "patna", "gaya", "bhubaneswar",
    "cuttack", "rourkela", "guwahati", "shillong", "kochi", "cochin", "thiruvananthapuram", "trivandrum",
    "kozhikode", "calicut", "thrissur", "panaji", "srinagar",
]
PLACE_FILLERS = [
    "remote", "hybrid", "onsite", "on-site", "work from home", "wfh", "office", "head office", "hq", "headquarters",
    "branch", "campus", "greater", "area", "region", "district", "city", "metro", "metropolitan", "urban", "rural",
]
