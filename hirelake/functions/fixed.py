"""Patterns, word lists and lookup tables that results depend on.

Everything in this module is data. Each value has to be exactly what it is for
results to be right; nothing here is logic.
"""

# A title is kept if it matches one of these (one pattern per line) ...
TECH_INCLUDE = r"""
software
developer
programmer
devops
\bdev ?sec ?ops\b
\bsre\b
site reliability
full[\s-]?stack
front[\s-]?end
back[\s-]?end
web (engineer|application)
\bdata (scientist|science|engineer|engineering|analyst|analytics|architect|modeler)
analytics engineer
machine learning
\bml\b
\bai\b
artificial intelligence
deep learning
\bnlp\b
computer vision
business intelligence
\bbi (developer|analyst|engineer)
\bcloud\b
\baws\b
\bazure\b
platform engineer
infrastructure engineer
\bsystems? (engineer|administrator|analyst)
sysadmin
\bnetwork (engineer|administrator|architect|analyst)
(solutions?|software|cloud|enterprise|data|security|technical|it|java|\.net|salesforce) architect
cyber ?security
information security
(application|network|cloud|it) security
security (engineer|analyst|architect)
penetration test
\bsoc analyst
\bqa (engineer|analyst|automation|tester|lead)
quality assurance (engineer|analyst|tester)
test automation
automation (test|qa)
\bsdet\b
software tester
\b(ios|android|mobile) (engineer|developer)
embedded (software|systems|engineer)
firmware
\bdatabase\b
\bdba\b
\bsql\b
\bit (support|specialist|analyst|manager|administrator|technician|director|engineer)
help ?desk
desktop support
technical support (engineer|specialist|analyst)
computer (scientist|engineer|programmer)
""".strip().split("\n")

# ... and none of these.
TECH_EXCLUDE = r"""
\bsales\b
recruit
talent acquisition
marketing
business develop
account (executive|manager)
real estate
mechanical
\bcivil\b
structural
electrical
chemical
manufacturing
construction
\bhvac\b
nurse
clinical
physician
data entry
\bai (trainer|tutor|writing|writer|content)
""".strip().split("\n")

# Fixed value: rejected titles worth a second look.
NEAR_MISS = r"engineer|developer|analyst|technolog|\bit\b|data|architect|comput|cloud|security"

# Fixed value: title words that suggest a senior role (label option B).
SENIOR_TITLE = r"\b(?:senior|sr\.?|lead|staff|principal|head|director|vp|chief)\b"

# Pay periods per year (hourly is 40 hours x 52 weeks).
PAY_PERIODS = {"YEARLY": 1, "MONTHLY": 12, "BIWEEKLY": 26, "WEEKLY": 52, "HOURLY": 2080}

# Experience level to seniority class.
SENIORITY = {
    "Internship": "Entry",
    "Entry level": "Entry",
    "Associate": "Entry",
    "Mid-Senior level": "Mid",
    "Director": "Senior",
    "Executive": "Senior",
}
CLASSES = ["Entry", "Mid", "Senior"]
WORK_TYPES = ["remote", "hybrid", "on-site"]

# States and their postal codes.
US_STATES = dict(
    line.split(" ", 1)
    for line in """
AL Alabama
AK Alaska
AZ Arizona
AR Arkansas
CA California
CO Colorado
CT Connecticut
DE Delaware
DC District of Columbia
FL Florida
GA Georgia
HI Hawaii
ID Idaho
IL Illinois
IN Indiana
IA Iowa
KS Kansas
KY Kentucky
LA Louisiana
ME Maine
MD Maryland
MA Massachusetts
MI Michigan
MN Minnesota
MS Mississippi
MO Missouri
MT Montana
NE Nebraska
NV Nevada
NH New Hampshire
NJ New Jersey
NM New Mexico
NY New York
NC North Carolina
ND North Dakota
OH Ohio
OK Oklahoma
OR Oregon
PA Pennsylvania
RI Rhode Island
SC South Carolina
SD South Dakota
TN Tennessee
TX Texas
UT Utah
VT Vermont
VA Virginia
WA Washington
WV West Virginia
WI Wisconsin
WY Wyoming
""".strip().split("\n")
)

# Fixed value: what may follow "hybrid" when it does not mean hybrid work.
NOT_HYBRID_WORK = r"cloud|infrastructure|it\b|app|mobile|architecture|solution|environment"

# Seniority keyword flags.
KEYWORD_FLAGS = {
    "kw_lead": r"\blead(?:s|ing)?\b",
    "kw_mentor": r"\bmentor(?:s|ing|ship)?\b",
    "kw_architect": r"\barchitect(?:s|ure|ing)?\b",
    "kw_intern": r"\bintern(?:s|ship)?\b",
    "kw_graduate": r"\b(?:new )?grad(?:uate)?s?\b",
    "kw_principal": r"\bprincipal\b",
}

# Number words read as years of experience.
NUMBER_WORDS = {
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6,
    "seven": 7, "eight": 8, "nine": 9, "ten": 10, "twelve": 12, "fifteen": 15,
}
MAX_REASONABLE_YEARS = 20

# Hiring boilerplate ignored when clustering by role.
BOILERPLATE_WORDS = """
status employment employer employers employee employees benefits benefit disability disabilities
gender identity expression equal opportunity opportunities protected veteran veterans race religion
sex sexual orientation national origin color age marital pregnancy genetic information applicants
applicant accommodation accommodations eeo affirmative action discrimination law laws regard
regardless qualified consideration pay salary compensation range bonus insurance dental vision
medical 401k pto paid time off holidays wellness perks company companies culture inclusive diversity
inclusion apply application hiring hire recruiting recruiter candidate candidates position positions
job jobs role roles join team teams w2 c2c contract duration month months location onsite remote
hybrid description title requirements required preferred qualifications responsibilities including
ability skills experience years work working strong excellent knowledge understanding environment
ensure provide new based world people business customer customers client clients management project
projects program technology technologies process processes services service solutions solution
product products organization support related level industry looking
""".split()

# English function words, the default of every `stop_words` parameter. A list of
# the user's own (for instance a longer published one) can be passed instead.
ENGLISH_STOP_WORDS = """
a an the this that these those such same other another each every either neither both all any some
few many much more most several no none
i me my mine myself we us our ours ourselves you your yours yourself he him his himself she her hers
herself it its itself they them their theirs themselves who whom whose which what
am is are was were be been being have has had having do does did done can could may might must shall
should will would cannot
and or but nor so yet if then else than because while although though unless until whereas whether as
about above across after against along among around at before behind below beneath beside between
beyond by down during except for from in into of off on onto out over per since through to toward
towards under up upon via with within without
not only also too very just even ever never always often now here there where when why how again
further once already still however therefore thus hence almost
""".split()

# Role names and the term that must be among a cluster's top terms.
ROLE_SIGNATURES = {
    "Data Science & ML": "machine learning",
    "Application Development (Java/.NET/Web)": "developer",
    "Software Engineering (Product)": "software engineer",
    "IT Support & Help Desk": "help desk",
    "Network & Systems Administration": "network",
    "Data & Business Analysis": "data analyst",
    "Software, Cloud & QA Engineering": "devops",
    "Data Engineering & BI": "data engineer",
    "Cybersecurity": "cybersecurity",
    "Solutions & Cloud Architecture": "architect",
}

# Columns read from a raw postings file.
POSTING_COLUMNS = """
job_id title description company_id company_name location formatted_experience_level
formatted_work_type remote_allowed min_salary med_salary max_salary pay_period currency
listed_time original_listed_time views applies
""".split()

# The skill dictionary, as name :: category :: pattern.
SKILL_TABLE = r"""
Python :: Language :: python
Java :: Language :: java(?!\s*script)
JavaScript :: Language :: javascript|java script|ecmascript|es6
TypeScript :: Language :: typescript
C++ :: Language :: c\+\+|cpp
C# :: Language :: c#|c sharp|csharp
C :: Language :: C(?=\s*/\s*C\+\+|\s*,\s*C\+\+|\s+(?:and|or)\s+C\+\+|\s+programming|\s+language)
Go :: Language :: golang|Go(?=\s*(?:/|,|\)|\s+(?:and|or)\s+[A-Z]|\s+programming|\s+language))
Rust :: Language :: Rust
Ruby :: Language :: ruby
PHP :: Language :: php
Kotlin :: Language :: kotlin
Swift :: Language :: Swift(?:UI)?
Objective-C :: Language :: objective[\s-]?c
Scala :: Language :: scala
R :: Language :: R(?=\s*(?:,|/|\)|\s+(?:and|or)\s+(?:Python|SQL|SAS)|\s+programming|\s+studio))|(?i:rstudio)
SQL :: Language :: sql|t-sql|tsql|pl/sql|plsql
Bash :: Language :: bash|shell scripting|shell script
PowerShell :: Language :: powershell
Perl :: Language :: perl
MATLAB :: Language :: matlab
SAS :: Language :: SAS
VBA :: Language :: vba
COBOL :: Language :: cobol
Dart :: Language :: Dart
Groovy :: Language :: groovy
HTML :: Language :: html5?
CSS :: Language :: css3?
React :: Frontend :: React(?:\.?js)?(?!\s*Native)(?!\s+(?:to|quickly|promptly|swiftly|appropriately|accordingly)\b)|(?i:reactjs)
Angular :: Frontend :: angular(?:\.?js)?
Vue.js :: Frontend :: vue(?:\.?js)?
Next.js :: Frontend :: next\.?js
Redux :: Frontend :: redux
jQuery :: Frontend :: jquery
Sass :: Frontend :: sass|scss
Tailwind :: Frontend :: tailwind(?:\s*css)?
Bootstrap :: Frontend :: Bootstrap
Webpack :: Frontend :: webpack
React Native :: Mobile :: react[\s-]?native
Flutter :: Mobile :: flutter
iOS :: Mobile :: ios
Android :: Mobile :: android
Xamarin :: Mobile :: xamarin
Node.js :: Backend :: node\.?js
Express :: Backend :: express\.?js
Django :: Backend :: django
Flask :: Backend :: flask
FastAPI :: Backend :: fastapi
Spring :: Backend :: spring\s*boot|spring\s*framework|spring\s*mvc|spring\s*cloud
.NET :: Backend :: \.net(?:\s*core)?|dotnet
ASP.NET :: Backend :: asp\.net
Ruby on Rails :: Backend :: (?i:ruby on rails)|Rails
Laravel :: Backend :: laravel
GraphQL :: Backend :: graphql
REST APIs :: Backend :: rest(?:ful)?\s*(?:api|apis|services|web services)|restful
Microservices :: Backend :: micro[\s-]?services?
Kafka :: Backend :: kafka
RabbitMQ :: Backend :: rabbitmq
PostgreSQL :: Database :: postgre(?:s|sql)
MySQL :: Database :: mysql
SQL Server :: Database :: sql server|mssql|ms sql
Oracle :: Database :: oracle
MongoDB :: Database :: mongo(?:db)?
Redis :: Database :: redis
Cassandra :: Database :: cassandra
DynamoDB :: Database :: dynamo\s*db
Elasticsearch :: Database :: elastic\s*search|elk stack
NoSQL :: Database :: nosql
Snowflake :: Database :: snowflake
BigQuery :: Database :: big\s*query
Redshift :: Database :: redshift
AWS :: Cloud :: aws|amazon web services
Azure :: Cloud :: azure
GCP :: Cloud :: gcp|google cloud
AWS Lambda :: Cloud :: lambda
Serverless :: Cloud :: serverless
Docker :: DevOps :: docker
Kubernetes :: DevOps :: kubernetes|k8s
OpenShift :: DevOps :: openshift
Helm :: DevOps :: Helm
Terraform :: DevOps :: terraform
CloudFormation :: DevOps :: cloud\s*formation
Ansible :: DevOps :: ansible
Puppet :: DevOps :: Puppet
Chef :: DevOps :: Chef(?=\s*(?:,|/|\)|\s+(?:and|or)\s+[A-Z]))
Jenkins :: DevOps :: jenkins
GitHub Actions :: DevOps :: github actions
CI/CD :: DevOps :: ci\s*/\s*cd|continuous integration|continuous delivery|continuous deployment
Git :: DevOps :: git
GitHub :: DevOps :: github
GitLab :: DevOps :: gitlab
Bitbucket :: DevOps :: bitbucket
Azure DevOps :: DevOps :: azure devops
Linux :: DevOps :: linux|red hat|rhel|ubuntu|centos
Unix :: DevOps :: unix
Prometheus :: DevOps :: prometheus
Grafana :: DevOps :: grafana
Datadog :: DevOps :: datadog
Splunk :: DevOps :: splunk
Machine Learning :: Data/ML :: machine learning|\bml\b
Deep Learning :: Data/ML :: deep learning|neural networks?
NLP :: Data/ML :: nlp|natural language processing
Computer Vision :: Data/ML :: computer vision
LLMs :: Data/ML :: llms?|large language models?
Generative AI :: Data/ML :: generative ai|gen\s*ai
TensorFlow :: Data/ML :: tensorflow
PyTorch :: Data/ML :: pytorch
Keras :: Data/ML :: keras
scikit-learn :: Data/ML :: scikit[\s-]?learn|sklearn
Pandas :: Data/ML :: pandas
NumPy :: Data/ML :: numpy
Spark :: Data/ML :: (?i:apache spark|pyspark)|Spark
Hadoop :: Data/ML :: hadoop|hdfs|hive
Databricks :: Data/ML :: databricks
Airflow :: Data/ML :: airflow
dbt :: Data/ML :: dbt
ETL :: Data/ML :: etl|elt
Data Warehousing :: Data/ML :: data warehous\w*
Data Modeling :: Data/ML :: data model(?:ing|ling)
Statistics :: Data/ML :: statistics|statistical
A/B Testing :: Data/ML :: a/b test\w*
Tableau :: Data/ML :: tableau
Power BI :: Data/ML :: power\s*bi
Looker :: Data/ML :: looker
Excel :: Data/ML :: Excel|(?i:ms excel|microsoft excel)
Selenium :: Testing :: selenium
Cypress :: Testing :: cypress
Jest :: Testing :: Jest
JUnit :: Testing :: junit
pytest :: Testing :: pytest
Postman :: Testing :: postman
Unit Testing :: Testing :: unit test\w*
Test Automation :: Testing :: test automation|automated test\w*
Cybersecurity :: Security :: cyber\s*security|information security|infosec
SIEM :: Security :: siem
Penetration Testing :: Security :: penetration test\w*|pen test\w*
IAM :: Security :: identity and access management|\biam\b
Firewalls :: Security :: firewalls?
CISSP :: Security :: cissp
Security+ :: Security :: security\+
Networking :: Infrastructure :: tcp/ip|dns|dhcp|routing and switching|lan/wan|networking
Cisco :: Infrastructure :: cisco|ccna|ccnp
VMware :: Infrastructure :: vmware|vsphere
Active Directory :: Infrastructure :: active directory
Windows Server :: Infrastructure :: windows server
Microsoft 365 :: Infrastructure :: office 365|microsoft 365|o365|m365
ITIL :: Infrastructure :: itil
ServiceNow :: Infrastructure :: servicenow
Salesforce :: Enterprise :: salesforce
SAP :: Enterprise :: SAP
SharePoint :: Enterprise :: sharepoint
Power Apps :: Enterprise :: power\s*apps
Mainframe :: Enterprise :: mainframe|z/os
Embedded Systems :: Embedded :: embedded (?:systems?|software|c)
RTOS :: Embedded :: rtos
FPGA :: Embedded :: fpga
Verilog/VHDL :: Embedded :: verilog|vhdl
Agile :: Practice :: agile
Scrum :: Practice :: scrum
Jira :: Practice :: jira
Confluence :: Practice :: confluence
System Design :: Practice :: system design|distributed systems
Object-Oriented Programming :: Practice :: object[\s-]oriented|\boop\b
Data Structures & Algorithms :: Practice :: data structures|algorithms
Figma :: Practice :: figma
Unity :: Practice :: Unity(?:3d)?(?=\s*(?:,|/|\)|\s+(?:and|or|engine|developer)))
""".strip()

# Skills that must appear with their exact capitals.
CASE_SENSITIVE_SKILLS = {
    "C", "Go", "Rust", "Swift", "R", "SAS", "Dart", "React", "Bootstrap", "Helm",
    "Puppet", "Chef", "Spark", "Jest", "SAP", "Unity", "Excel", "Ruby on Rails",
}

# The words a match of a pattern can begin with, for the patterns that are more
# than a list of plain words (see hirelake.functions.skills).
SKILL_FIRST_WORDS = """
Java: java
C: c
Go: golang go
Rust: rust
Swift: swift swiftui
Objective-C: objective objectivec
R: r rstudio
SQL: sql tsql plsql
SAS: sas
Dart: dart
HTML: html html5
CSS: css css3
React: react reactjs
Angular: angular angularjs
Vue.js: vue vuejs
Next.js: next nextjs
Tailwind: tailwind tailwindcss
Bootstrap: bootstrap
React Native: react reactnative
Node.js: node nodejs
Express: express expressjs
Spring: spring springboot springframework springmvc springcloud
.NET: net netcore dotnet
ASP.NET: asp
Ruby on Rails: ruby rails
REST APIs: rest restful restapi restapis restservices restweb restfulapi restfulapis restfulservices restfulweb
Microservices: micro microservice microservices
PostgreSQL: postgres postgresql
MongoDB: mongo mongodb
DynamoDB: dynamo dynamodb
Elasticsearch: elastic elasticsearch elk
BigQuery: big bigquery
Helm: helm
CloudFormation: cloud cloudformation
Puppet: puppet
Chef: chef
CI/CD: ci continuous
Machine Learning: machine ml
Deep Learning: deep neural
LLMs: llm llms large
Generative AI: generative gen genai
scikit-learn: scikit scikitlearn sklearn
Spark: apache pyspark spark
Data Warehousing: data
Data Modeling: data
A/B Testing: a
Power BI: power powerbi
Excel: excel ms microsoft
Jest: jest
Unit Testing: unit
Test Automation: test automated
Cybersecurity: cyber cybersecurity information infosec
Penetration Testing: penetration pen
IAM: identity iam
Firewalls: firewall firewalls
SAP: sap
Power Apps: power powerapps
Embedded Systems: embedded
Object-Oriented Programming: object oop
Unity: unity unity3d
""".strip()

# Settings of the classifiers and the grids they are tuned over, and of the role clusters. Equal to those of the behaviour to be matched.
CLASSIFIER_SETTINGS = {
    "Logistic Regression": {"C": 3.0, "max_iter": 3000},
    "Linear SVM": {"C": 0.3, "max_iter": 5000},
    "Boosted Trees": {"max_depth": 6, "rounds": 200, "rate": 0.15},
}
CLASSIFIER_GRIDS = {
    "Logistic Regression": {"C": [0.3, 1, 3, 10], "max_features": [10_000, 20_000]},
    "Linear SVM": {"C": [0.03, 0.1, 0.3, 1], "max_features": [10_000, 20_000]},
    "Boosted Trees": {"max_depth": [4, 6]},
}
MAX_TERMS = {"Logistic Regression": 20_000, "Linear SVM": 20_000, "Boosted Trees": 3_000}
BOOSTED_SAMPLE, BOOSTED_COLUMNS = 0.8, "0.5"
CV_FOLDS = 5
ROLE_CLUSTERS, ROLE_RANGE, ROLE_STARTS, ROLE_DIMS = 10, (4, 15), 10, 100

# A token of the term vectors.
TOKEN_PATTERN = r"(?<![\w])[a-z][a-z0-9+#]*(?:\.[a-z]+)?"

# A number of years, perhaps up to another one, and what must follow it.
YEARS_NUMBER = r"(\d{1,2}|" + "|".join(NUMBER_WORDS) + ")"
YEARS_PATTERN = YEARS_NUMBER + r"\s*(?:\(\d{1,2}\)\s*)?\+?\s*(?:(?:-|–|to)\s*" + YEARS_NUMBER + r"\s*\+?\s*)?(?:years?|yrs?\.?)"
YEARS_FOLLOWED_BY = r"(?![a-z])(?=[^.;\n]{0,60}experience)"

# What must not stand before and after a skill.
SKILL_NOT_BEFORE, SKILL_NOT_AFTER = r"(?<![\w+#])", r"(?![\w+#])(?!\.[\w])"
