"""Patterns that decide what is recognised.

Each cascade is tried in order. All are given in the syntax that java.util.regex shares
with most engines; flags are set where they are used.
"""

# They must be as they are for right results.

PATIENT_NAME = (
    r"CLIENT:\s*([A-Z]+,\s*[A-Z]+(?:\s+[A-Z]\.?)*)(?:\s|$)",
    r"Patient:?\s*([A-Z]+,\s*[A-Z]+(?:\s+[A-Z]\.?)*)(?:\s|$)",
    r"([A-Z][a-z]+,\s*[A-Z][a-z]+(?:\s+[A-Z]\.?)?)\s*\(\s*[A-Z0-9]{3,}\s*\)",
    r"([A-Z][a-z]+,\s*[A-Z][a-z]+(?:\s+[A-Z]\.?)?)\s*\([A-Z0-9]{3,}\)",
    r"(?:Name|Patient).*?(?:Number|Address|Gender|Birth)\s+([A-Z][a-z]+,\s*[A-Z][a-z]+(?:\s+[A-Z]\.?)?)\s+(?:Male|Female|M|F|\d)",
    r"CLIENT:.*?(?:MD|DO)\s+([A-Z][A-Za-z\s,.-]+?)(?:\s+\d|\s*$|\n)",
    r"CLIENT:\s*([A-Z][a-z]+,\s*[A-Z][a-z]+(?:\s+[A-Z]\.?)?)",
    r"Patient:\s*([A-Z][a-z]+,\s*[A-Z][a-z]+(?:\s+[A-Z]\.?)?)",
    r"^([A-Z][a-z]+,\s*[A-Z][a-z]+(?:\s+[A-Z]\.?)?)\s*$",
    r"(?:patient|client)\s+name:?\s*([A-Z][a-z]+,\s*[A-Z][a-z]+(?:\s+[A-Z]\.?)?)",
)

DOB = (
    r"Patient'?s?\s+Date\s+of\s+Birth:?\s*(\d{1,2}/\d{1,2}/\d{4})",
    r"DOB:?\s*(\d{1,2}/\d{1,2}/\d{4})",
    r"Date\s+of\s+Birth:?\s*([A-Za-z]+\s+\d{1,2},\s+\d{4})",
    r"(?:born|birth|dob)(?:\s+date)?:?\s*(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
)

GENDER = (
    r"Patient'?s?\s+Gender:?\s*(MALE|FEMALE|M|F)(?!\s+or\s+F)(?!\s+or\s+M)",
    r"Sex:?\s*([MF]|MALE|FEMALE)(?!\s+or\s+[MF])(?!\s+or\s+MALE|FEMALE)",
    r"Gender:?\s*(MALE|FEMALE|M|F)(?!\s+or\s+[MF])(?!\s+or\s+MALE|FEMALE)",
    r"(?<!or\s)(?<!Gender\s)(?<!Sex\s)\b(MALE|FEMALE)\b(?!\s+or\s+)",
    r"(?<!or\s)(?<!/)\b([MF])\b(?!\s+or\s+[MF])(?!/)",
    r"Patient.*?(?:Gender|Sex).*?:?\s*(MALE|FEMALE|M|F)(?!\s+or)",
)

MRN = (
    r"\(([A-Z]{2}\d{12})\)",
    r"Patient:?\s+[A-Za-z,\s]+\s+\(([A-Z]{2}\d{12})\)",
    r"Medical\s+Record\s+No\.?\s+([A-Za-z0-9]+)(?:\s+Provider|\s+\d|\s*$)",
    r"Medical\s+Record\s+No\..*?([A-Za-z]{3}\d{11})(?:\s+\d|\s*$)",
    r"MR#:?\s*([A-Za-z0-9]+)",
    r"MR[#F]?:?\s*([A-Za-z0-9]{8,})",
    r"(?:mrn|medical\s+record|patient\s+id)(?:\s+no)?\.?\s*:?\s*([A-Za-z0-9]{10,})",
    r"\b((?:MA|RLN|C0|C02|HH|HS)[A-Z0-9]{8,13})\b",
    r"Patient:?\s+[A-Za-z,\s]+\s*\((\d{9,10})\)",
    r"[A-Z][A-Za-z]+,\s*[A-Z][A-Za-z]+\s*\((\d{9,10})\)",
    r"\((\d{9,10})\)",
    r"MR\s+Number:?\s*([A-Za-z0-9]{6,})",
    r"Patient:?[\sA-Za-z,]+-?\s*MR#?\s*([A-Za-z0-9]{6,})",
)

MEDICARE = (
    r"Patient'?s?\s+Medicare\s+No\.?\s+([A-Za-z0-9]+)(?:\s+\d|\s+SOC|\s*$)",
    r"Medicare\s+No\..*?([A-Za-z0-9]{10,})(?:\s+\d|\s*$)",
    r"Medicare:?\s*([A-Za-z0-9]{10,})",
)

SSN = (
    r"SSN:?\s*(\d{3}-\d{2}-\d{4})",
    r"\b(\d{3}[-\s]?\d{2}[-\s]?\d{4})\b",
)

ORDER_NUMBER = (
    r"Order\s+Number\s+#(\d{10})",
    r"Order\s+#(\d{10})",
    r"Order\s+Number:?\s*(\d{6,})",
    r"Order\s+Number:?\s*(?:[A-Z\s]+?)(\d{8,})",
    r"Order\s+(?:Number|No)\.?\s*:?\s*(\d{6,})",
)

ORDER_DATE = (
    r"Visit\s+Date:?:?\s*(\d{1,2}/\d{1,2}/\d{4})",
    r"Date\s+order\s+received:?:?\s*(\d{1,2}/\d{1,2}/\d{4})",
    r"Date\s+order\s+received:?:?\s*(\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{2}(?::\d{2})?\s*[AP]M)",
    r"Order\s+Date:?\s*(\d{1,2}/\d{1,2}/\d{4})",
    r"Order\s+Date:?\s*(\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{2}\s*[AP]M)",
    r"Order\s+Date:?\s*(\d{1,2}/\d{1,2}/\d{4}\s+\d{1,2}:\d{2}:\d{2}\s*[AP]M)",
    r"(?:ordered|order\s+date|date\s+ordered):?\s*(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
)

SOC = (
    r"SOC\s+Date:?\s*(\d{1,2}/\d{1,2}/\d{4})",
    r"Start\s+of\s+Care:?\s*(\d{1,2}/\d{1,2}/\d{4})",
    r"(?:start|soc)(?:\s+of\s+care|\s+date)?:?\s*(\d{1,2}[/-]\d{1,2}[/-]\d{2,4})",
)

CERT_PERIOD = (
    r"Certification\s+Period:?\s*(\d{1,2}/\d{1,2}/\d{4})\s+to\s+(\d{1,2}/\d{1,2}/\d{4})",
    r"CERT:?\s*(\d{1,2}/\d{1,2}/\d{4})\s+to\s+(\d{1,2}/\d{1,2}/\d{4})",
    r"(\d{1,2}/\d{1,2}/\d{4})\s+Through\s+(\d{1,2}/\d{1,2}/\d{4})",
    r"Episode:?\s*(\d{1,2}/\d{1,2}/\d{4})\s*(?:-|\u2013|\u2014|to|To|through)[:]?\s*(\d{1,2}/\d{1,2}/\d{4})",
    r"Episode\s+[A-Za-z\s]*?(\d{1,2}/\d{1,2}/\d{4})\s*(?:-|\u2013|\u2014|to|To|through)[:]?\s*(\d{1,2}/\d{1,2}/\d{4})",
    r"Certification\s+Period:?:?\s*(\d{1,2}/\d{1,2}/\d{4})\s*[-\u2013\u2014]{1,2}\s*(\d{1,2}/\d{1,2}/\d{4})",
    r"Certification\s+Period[^\d]{0,20}(\d{1,2}/\d{1,2}/\d{4})\s*(?:-|to|To|through|\u2013|\u2014)\s*(\d{1,2}/\d{1,2}/\d{4})",
    r"Service\s+Dates?:?\s*(\d{4}-\d{2}-\d{2})\s*(?:-|to|through|\u2013|\u2014|\u2192|\u27a1)\s*(\d{4}-\d{2}-\d{2})",
    r"Episode\s+(?:Dates?|Period|Span|Range)?[:\s]*?(\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}-\d{2}-\d{2})\s*[\u2190\u2192\u27A1\u2012\u2013\u2014\u2015-]\s*(\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|\d{4}-\d{2}-\d{2})",
    r"([A-Za-z]{3,9}\s+\d{1,2},\s+\d{4})\s*[\u2190\u2192\u27A1\u2012\u2013\u2014\u2015-]\s*([A-Za-z]{3,9}\s+\d{1,2},\s+\d{4})",
)

PHYSICIAN = (
    r"([A-Z][A-Za-z]+(?:\s+[A-Z]\.?)*\s+[A-Z][A-Za-z]+,\s*MD)",
    r"([A-Z][A-Za-z]+(?:\s+[A-Z]\.?)*\s+[A-Z][A-Za-z]+,\s*DO)",
    r"PHYSICIAN:?\s*([A-Z][A-Za-z\s,.-]+,\s*MD)",
    r"Dr\.?\s+([A-Z][A-Za-z\s,.-]+)",
    r"(?:physician|doctor|dr|attending):?\s*([A-Z][A-Za-z\s,.-]+(?:,\s*MD|,\s*DO)?)",
)

PHONE = (
    r"Phone:?\s*\((\d{3})\)\s*(\d{3})-(\d{4})",
    r"\((\d{3})\)\s*(\d{3})-(\d{4})",
    r"(?:phone|tel|telephone):?\s*(\(?\d{3}\)?[-.\s]*\d{3}[-.\s]*\d{4})",
)

ADDRESS = (
    r"(\d+\s+[A-Z][A-Za-z\s]+(?:ROAD|STREET|ST|AVENUE|AVE|DRIVE|DR|LANE|LN|BOULEVARD|BLVD)[A-Za-z\s,]*\d{5})",
    r"(\d+\s+[A-Z][A-Za-z\s]+[A-Z]{2}\s+\d{5})",
    r"(\d+\s+[A-Za-z\s]+(?:Street|St|Road|Rd|Avenue|Ave|Drive|Dr|Lane|Ln|Boulevard|Blvd)[A-Za-z\s,]*)",
)

DIAGNOSIS = (
    r"([A-Z][0-9]{2}(?:\.[0-9A-Z]{1,4})?)\s+([A-Z][A-Za-z0-9\s,.\-'():/]+?)(?:\s+Start Effective Date|\s+\([EO]\)|\s*$)",
    r"\d+\s+([A-Z]\d{2}\.?\d*[A-Z]*)\s+([A-Z][A-Za-z\s,]+)",
    r"(?:Primary|Secondary)\s+Diagnosis\s+Code\s+Description\s+([A-Z][0-9]{2}(?:\.[0-9A-Z]{1,4})?)\s+([A-Za-z0-9\s,.\-'():/]+)",
    r"(?:diagnosis|dx|icd):?\s*([A-Z]\d{2}\.?\d*[A-Z]*)\s*([A-Za-z\s,]+)",
    r"Medical\s+Diagnosis:\s*([A-Z][0-9]{2}(?:\.[0-9A-Z]{1,4})?)",
    r"([A-Z][A-Za-z0-9\s,.\-'():/]+?)\s+\(([A-Z][0-9]{2}(?:\.[0-9A-Z]{1,4})?)\)",
)

PROVIDER = (
    r"(?:Agency\s+Name|Agency|Provider/Agency)\s*[:\-]?\s*([A-Z][A-Za-z0-9 &'.,-]{3,50})",
    r"([A-Z][A-Za-z0-9 &'.,-]{3,40}\s+(?:Home\s+Health|Home\s*Care|Health\s*Care|Healthcare|Hospice|Visiting\s+Nurse|VNA)(?:\s+of\s+[A-Z][A-Za-z]+)?)",
    r"([A-Z][A-Za-z0-9 &'.,-]{3,40}\s+at\s+Home)",
    r"(ACCENTCARE[A-Za-z\s,.-]{0,30}|Community\s+Nurse[A-Za-z\s,.-]{0,30}|NURSE\s+ON\s+CALL[A-Za-z\s-]{0,30})",
    r"(AlphaCare\s+Home\s+Health)",
    r"(Nightingale\s+Visiting\s+Nurse)",
    r"(VISITING\s+NURSE\s+HOME\s+AND\s+HOSPICE)",
    r"(FALL\s+RIVER\s+-\s+CENTERWELL\s+HOME\s+HEALTH)",
    r"(VNHH\s+HOSPICE)",
    r"(AMEDISYS\s+HOME\s+HEALTH)",
)

ENHANCED_DOB = (
    r"(?:DOB|Date\s*of\s*Birth|Birth\s*Date|Born)\s*:?\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4})",
    r"(?:DOB|Date\s*of\s*Birth|Birth\s*Date|Born)\s*:?\s*([A-Za-z]+\s+\d{1,2},?\s+\d{4})",
    r"Patient.*?(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{4}).*?(?:Age|years?\s*old)",
    r"(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{4}).*?(?:Age|years?\s*old)",
    r"Age\s*\d+.*?(?:DOB|Born|Birth)[:\s]*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{4})",
    r"Patient\s*Information.*?(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{4})",
    r"Demographics.*?(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{4})",
    r"Birth\s*Date[:\s]*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{4})",
    r"D\.?O\.?B\.?\s*:?\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{4})",
    r"(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{4})\s*\([^)]*(?:birth|born|DOB)[^)]*\)",
    r"\b(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{4})\b(?=.*(?:patient|birth|born|age))",
)

ENHANCED_SSN = (
    r"(?:SSN|Social\s*Security|Social\s*Security\s*Number)\s*:?\s*(\d{3}[-.\\s]?\d{2}[-.\\s]?\d{4})",
    r"(?:SS#|SSN#)\s*:?\s*(\d{3}[-.\\s]?\d{2}[-.\\s]?\d{4})",
    r"Social\s*:?\s*(\d{3}[-.\\s]?\d{2}[-.\\s]?\d{4})",
    r"\b(\d{3}[-.]?\d{2}[-.]?\d{4})\b(?=.*(?:social|ssn|security))",
    r"Security\s*Number\s*:?\s*(\d{3}[-.\\s]?\d{2}[-.\\s]?\d{4})",
)

ENHANCED_MRN = (
    r"(?:MRN|Medical\s*Record\s*Number|Medical\s*Record|Patient\s*ID)\s*:?\s*([A-Za-z0-9\-]{4,15})",
    r"(?:Record\s*Number|Record\s*#|Patient\s*Number)\s*:?\s*([A-Za-z0-9\-]{4,15})",
    r"(?:Chart\s*Number|Chart\s*#)\s*:?\s*([A-Za-z0-9\-]{4,15})",
    r"(?:ID|Identifier)\s*:?\s*([A-Za-z0-9\-]{6,15})",
    r"MR#\s*:?\s*([A-Za-z0-9\-]{4,15})",
    r"Patient.*?ID\s*:?\s*([A-Za-z0-9\-]{4,15})",
    r"Patient:?\s+[A-Za-z,\s]+\s*\((\d{9,10})\)",
    r"[A-Z][A-Za-z]+,\s*[A-Z][A-Za-z]+\s*\((\d{9,10})\)",
    r"\((\d{9,10})\)",
    r"MR\s+Number:?\s*([A-Za-z0-9\-]{6,15})",
    r"Patient:?[\sA-Za-z,]+-?\s*MR#?\s*([A-Za-z0-9\-]{6,15})",
)

ENHANCED_EPISODE_START = (
    r"(?:Episode\s*Start|Start\s*of\s*Care|SOC|Care\s*Start)\s*:?\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4})",
    r"(?:Start\s*Date|Begin\s*Date|Admission\s*Date)\s*:?\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4})",
    r"(?:From|Starting)\s*:?\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4})",
    r"Care\s*Period\s*:?\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4})\s*(?:to|through|-)",
    r"Service\s*Start\s*:?\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4})",
    r"Certification\s+Period:?\s*(\d{1,2}[/\-\.]{1}\d{1,2}[/\-\.]{1}\d{2,4})",
)

ENHANCED_EPISODE_END = (
    r"(?:Episode\s*End|End\s*of\s*Care|Care\s*End)\s*:?\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4})",
    r"(?:End\s*Date|Discharge\s*Date|Termination\s*Date)\s*:?\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4})",
    r"(?:To|Until|Through)\s*:?\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4})",
    r"Care\s*Period\s*:?\s*\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4}\s*(?:to|through|-)\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4})",
    r"Service\s*End\s*:?\s*(\d{1,2}[/\-\.]\d{1,2}[/\-\.]\d{2,4})",
)

ENHANCED_NPI = (
    r"(?:NPI|National\s*Provider\s*Identifier)\s*:?\s*(\d{10})",
    r"(?:Provider\s*Number|Provider\s*ID)\s*:?\s*(\d{10})",
    r"NPI#\s*:?\s*(\d{10})",
    r"Physician.*?NPI\s*:?\s*(\d{10})",
    r"Doctor.*?NPI\s*:?\s*(\d{10})",
    r"\b(\d{10})\b(?=.*(?:NPI|provider|physician))",
)

ENHANCED_DIAGNOSIS = (
    r"(?:Primary\s*Diagnosis|Primary\s*Dx|Diagnosis\s*1)\s*:?\s*([^:\n]+?)(?:\n|$|Diagnosis\s*2)",
    r"(?:Principal\s*Diagnosis)\s*:?\s*([^:\n]+?)(?:\n|$)",
    r"(?:Main\s*Diagnosis)\s*:?\s*([^:\n]+?)(?:\n|$)",
    r"(?:Secondary\s*Diagnosis|Secondary\s*Dx|Diagnosis\s*2)\s*:?\s*([^:\n]+?)(?:\n|$|Diagnosis\s*3)",
    r"(?:Additional\s*Diagnosis)\s*:?\s*([^:\n]+?)(?:\n|$)",
    r"(?:Diagnosis|Dx)\s*:?\s*([^:\n]+?)(?:\n|$)",
    r"(?:ICD-?10?)\s*:?\s*([A-Z]\d{2}(?:\.\d{1,2})?)\s*([^:\n]+?)(?:\n|$)",
    r"(?:ICD-?9?)\s*:?\s*(\d{3}(?:\.\d{1,2})?)\s*([^:\n]+?)(?:\n|$)",
    r"(?:Condition|Medical\s*Condition)\s*:?\s*([^:\n]+?)(?:\n|$)",
    r"(?:Problem|Health\s*Problem)\s*:?\s*([^:\n]+?)(?:\n|$)",
)

ENHANCED_INSURANCE = (
    r"(?:Insurance|Primary\s*Insurance|Payer)\s*:?\s*([^:\n]+?)(?:\n|$)",
    r"(?:Coverage|Health\s*Plan)\s*:?\s*([^:\n]+?)(?:\n|$)",
    r"(?:Carrier|Insurance\s*Carrier)\s*:?\s*([^:\n]+?)(?:\n|$)",
    r"(?:Plan|Insurance\s*Plan)\s*:?\s*([^:\n]+?)(?:\n|$)",
)

