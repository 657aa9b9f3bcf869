"""Seed data: classes, attribute questions, class words and extraction rules."""

from __future__ import annotations

from typing import NamedTuple

# The document classes and the question asked for each attribute.
CLASSES = (
    "w2",
    "vendor_contract",
    "sales_report",
    "marketing_report",
    "hr_policy",
    "corporate_policy",
    "financial_infographic",
    "case_study",
    "strategy_document",
    "other",
)

QUESTIONS = (
    ("w2", "employee_name", "What is the employee's full legal name as shown on the W-2?"),
    ("w2", "employer_name", "What is the employer company name on the W-2?"),
    ("w2", "employer_ein", "What is the Employer Identification Number (EIN)?"),
    ("w2", "tax_year", "What tax year is this W-2 for?"),
    ("w2", "wages_tips_compensation", "What is the amount in Box 1 - Wages, tips, other compensation?"),
    ("w2", "federal_income_tax_withheld", "What is the amount in Box 2 - Federal income tax withheld?"),
    ("w2", "social_security_wages", "What is the amount in Box 3 - Social security wages?"),
    ("w2", "social_security_tax_withheld", "What is the amount in Box 4 - Social security tax withheld?"),
    ("w2", "medicare_wages", "What is the amount in Box 5 - Medicare wages and tips?"),
    ("w2", "state", "What state is listed for state income tax on the W-2?"),
    ("vendor_contract", "vendor_name", "What is the name of the vendor or service provider?"),
    ("vendor_contract", "client_name", "What is the name of the client or customer company?"),
    ("vendor_contract", "contract_effective_date", "When does the contract become effective?"),
    ("vendor_contract", "contract_expiration_date", "When does the contract expire or end?"),
    ("vendor_contract", "contract_term_months", "What is the length of the contract in months or years?"),
    ("vendor_contract", "total_contract_value", "What is the total value of the contract? Include currency."),
    ("vendor_contract", "payment_terms", "What are the payment terms or payment schedule (e.g., Net 30, monthly, quarterly)?"),
    ("vendor_contract", "services_description", "What services or products are being provided? Provide a brief description."),
    ("vendor_contract", "auto_renewal_clause", "Does the contract have an automatic renewal clause? (Yes/No)"),
    ("vendor_contract", "termination_notice_period", "How many days or months notice is required for termination?"),
    ("sales_report", "reporting_period", "What reporting period does this cover (e.g., Q4 2024, FY2025, December 2024)?"),
    ("sales_report", "total_revenue", "What is the total revenue for the reporting period? Include currency."),
    ("sales_report", "revenue_growth_percent", "What is the revenue growth percentage (year-over-year or period-over-period)?"),
    ("sales_report", "top_performing_region", "What is the top performing sales region or territory?"),
    ("sales_report", "new_customers_count", "How many new customers were acquired during this period?"),
    ("sales_report", "average_deal_size", "What is the average deal size or average contract value?"),
    ("sales_report", "sales_pipeline_value", "What is the total value of the sales pipeline?"),
    ("sales_report", "quota_attainment_percent", "What percentage of sales quota was achieved?"),
    ("marketing_report", "campaign_name", "What is the name of the marketing campaign?"),
    ("marketing_report", "reporting_period", "What time period does this campaign report cover?"),
    ("marketing_report", "campaign_budget", "What was the total budget allocated for this campaign? Include currency."),
    ("marketing_report", "total_impressions", "How many total impressions or views were generated?"),
    ("marketing_report", "total_clicks", "How many total clicks were received?"),
    ("marketing_report", "click_through_rate", "What is the click-through rate (CTR) as a percentage?"),
    ("marketing_report", "conversion_rate", "What is the conversion rate as a percentage?"),
    ("marketing_report", "cost_per_acquisition", "What is the cost per acquisition (CPA) or cost per lead?"),
    ("marketing_report", "roi_percent", "What is the return on investment (ROI) as a percentage?"),
    ("hr_policy", "document_title", "What is the official title of this HR policy or handbook?"),
    ("hr_policy", "effective_date", "When does this policy become effective or was it last updated?"),
    ("hr_policy", "version_number", "What is the version number or revision number of this document?"),
    ("hr_policy", "department", "Which department is responsible for this policy (e.g., HR, Legal, Compliance)?"),
    ("hr_policy", "policy_type", "What type of policy is this (e.g., Employee Handbook, Performance Review Guidelines, Code of Conduct)?"),
    ("hr_policy", "approval_authority", "Who approved this policy (e.g., CEO, Board, HR Director)?"),
    ("hr_policy", "last_review_date", "When was this policy last reviewed?"),
    ("corporate_policy", "policy_name", "What is the name of this corporate policy?"),
    ("corporate_policy", "policy_category", "What category does this policy fall under (e.g., Expense Policy, Travel Policy, Vendor Management)?"),
    ("corporate_policy", "effective_date", "When does this policy take effect?"),
    ("corporate_policy", "approval_date", "When was this policy approved?"),
    ("corporate_policy", "policy_owner", "Which department or role owns this policy?"),
    ("corporate_policy", "approval_levels_required", "What approval levels or authorities are required under this policy?"),
    ("corporate_policy", "spending_limits", "What are the key spending limits or monetary thresholds mentioned?"),
    ("corporate_policy", "review_frequency", "How often is this policy reviewed (e.g., annually, quarterly)?"),
    ("financial_infographic", "quarter", "Which fiscal quarter is reported (e.g., Q1, Q2, Q3, Q4)?"),
    ("financial_infographic", "fiscal_year", "Which fiscal year is reported?"),
    ("financial_infographic", "revenue", "What is the total revenue for the period? Include currency and units."),
    ("financial_infographic", "revenue_growth_percent", "What is the year-over-year revenue growth percentage?"),
    ("financial_infographic", "operating_margin", "What is the operating margin as a percentage?"),
    ("financial_infographic", "net_income", "What is the net income or profit for the period?"),
    ("financial_infographic", "customers_count", "How many total customers are reported?"),
    ("financial_infographic", "customers_over_1m_count", "How many customers have trailing 12-month revenue over $1M (enterprise customers)?"),
    ("financial_infographic", "net_revenue_retention_rate", "What is the net revenue retention rate (NRR) as a percentage?"),
    ("financial_infographic", "gross_margin", "What is the gross margin as a percentage?"),
    ("case_study", "customer_name", "What is the name of the featured customer or company?"),
    ("case_study", "industry", "What industry does the customer operate in?"),
    ("case_study", "use_case", "What was the primary use case or business problem being solved?"),
    ("case_study", "business_impact", "What was the key business impact or result achieved?"),
    ("case_study", "metrics_improved", "What specific metrics improved (e.g., 50% cost reduction, 2x faster processing)?"),
    ("case_study", "implementation_duration", "How long did the implementation take?"),
    ("case_study", "testimonial_quote", "What is the key testimonial or quote from the customer?"),
    ("strategy_document", "document_title", "What is the title of this strategy document?"),
    ("strategy_document", "planning_period", "What time period does this strategy cover (e.g., 2025, FY2025, Q1-Q4 2025)?"),
    ("strategy_document", "department", "Which department or business unit does this strategy belong to (e.g., Marketing, Sales, Corporate)?"),
    ("strategy_document", "strategic_goals", "What are the main strategic goals or objectives?"),
    ("strategy_document", "key_initiatives", "What are the major initiatives or programs planned?"),
    ("strategy_document", "budget_allocation", "What is the total budget or key budget allocations mentioned?"),
    ("strategy_document", "success_metrics", "What are the key performance indicators (KPIs) or success metrics?"),
    ("strategy_document", "document_date", "When was this strategy document created or published?"),
    ("other", "document_title", "What is the title of this document?"),
    ("other", "document_date", "What is the document's date or most relevant date?"),
)


class ClassWord(NamedTuple):
    """A word that speaks for a class, with its weight."""

    document_class: str
    term: str
    weight: float = 1.0


class ExtractRule(NamedTuple):
    """Pattern that answers one question; group 1 is the value."""

    document_class: str
    attribute_name: str
    pattern: str


CLASS_WORDS = tuple(
    ClassWord(name, term, weight)
    for name, words in {
        "w2": {"w-2": 3, "wages": 2, "withheld": 2, "medicare": 2, "employer": 1, "social security": 2, "tax": 1},
        "vendor_contract": {"agreement": 2, "vendor": 2, "contract": 2, "termination": 2, "party": 1, "services": 1},
        "sales_report": {"sales": 2, "revenue": 1, "quota": 3, "region": 1, "deal": 2, "forecast": 1},
        "marketing_report": {"campaign": 3, "impressions": 3, "clicks": 2, "conversion": 2, "leads": 1, "marketing": 2},
        "hr_policy": {"employee": 2, "handbook": 3, "leave": 2, "conduct": 2, "benefits": 2, "human resources": 3},
        "corporate_policy": {"policy": 2, "compliance": 2, "approval": 2, "expense": 2, "travel": 1, "reimbursement": 2},
        "financial_infographic": {"fiscal": 2, "net income": 3, "operating margin": 3, "earnings": 2, "quarter": 1},
        "case_study": {"case study": 3, "customer": 1, "challenge": 2, "solution": 2, "testimonial": 3, "results": 1},
        "strategy_document": {"strategy": 3, "initiative": 2, "objectives": 2, "roadmap": 2, "goals": 1, "vision": 2},
    }.items()
    for term, weight in words.items()
)

_MONEY = r"([$€£]\s?\d[\d,.]*(?:\s?(?:million|billion|[MBK])\b)?)"
_PERCENT = r"(-?\d+(?:\.\d+)?\s?%)"
_DAY = r"(\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|[A-Z][a-z]{2,8} \d{1,2}, \d{4})"
_NAME = r"([A-Z][\w&.,' -]{1,80})"


def _labelled(label: str, value: str) -> str:
    return rf"(?i:{label})\s*[:\-]?\s*{value}"


EXTRACT_RULES = tuple(
    ExtractRule(*row)
    for row in (
        ("w2", "employee_name", _labelled("employee(?:'s)? name", _NAME)),
        ("w2", "employer_name", _labelled("employer(?:'s)? name", _NAME)),
        ("w2", "employer_ein", r"\b(\d{2}-\d{7})\b"),
        ("w2", "tax_year", _labelled("tax year", r"(\d{4})")),
        ("w2", "wages_tips_compensation", _labelled("wages, tips, other compensation", _MONEY)),
        ("w2", "federal_income_tax_withheld", _labelled("federal income tax withheld", _MONEY)),
        ("w2", "social_security_wages", _labelled("social security wages", _MONEY)),
        ("w2", "social_security_tax_withheld", _labelled("social security tax withheld", _MONEY)),
        ("w2", "medicare_wages", _labelled("medicare wages(?: and tips)?", _MONEY)),
        ("w2", "state", _labelled("state", r"([A-Z]{2})\b")),
        ("vendor_contract", "vendor_name", _labelled("vendor|service provider", _NAME)),
        ("vendor_contract", "client_name", _labelled("client|customer", _NAME)),
        ("vendor_contract", "contract_effective_date", _labelled("effective(?: date)?", _DAY)),
        ("vendor_contract", "contract_expiration_date", _labelled("expir(?:es|ation date)", _DAY)),
        ("vendor_contract", "contract_term_months", _labelled("term", r"(\d+ (?:months|years))")),
        ("vendor_contract", "total_contract_value", _labelled("total(?: contract)? value", _MONEY)),
        ("vendor_contract", "payment_terms", r"(?i)\b(net \d+|monthly|quarterly|annually)\b"),
        ("vendor_contract", "auto_renewal_clause", r"(?i)(auto(?:matic(?:ally)?)?[- ]renew\w*)"),
        ("vendor_contract", "termination_notice_period", r"(?i)(\d+ (?:days|months))['’]? (?:prior )?(?:written )?notice"),
        ("sales_report", "reporting_period", r"\b(Q[1-4] \d{4}|FY ?\d{4})\b"),
        ("sales_report", "total_revenue", _labelled("total revenue", _MONEY)),
        ("sales_report", "revenue_growth_percent", _labelled("revenue growth", _PERCENT)),
        ("sales_report", "top_performing_region", _labelled("top(?: performing)? region", _NAME)),
        ("sales_report", "new_customers_count", _labelled("new customers", r"([\d,]+)")),
        ("sales_report", "average_deal_size", _labelled("average deal size", _MONEY)),
        ("sales_report", "sales_pipeline_value", _labelled("sales pipeline", _MONEY)),
        ("sales_report", "quota_attainment_percent", _labelled("quota attainment", _PERCENT)),
        ("marketing_report", "campaign_name", _labelled("campaign(?: name)?", _NAME)),
        ("marketing_report", "reporting_period", r"\b(Q[1-4] \d{4}|FY ?\d{4})\b"),
        ("marketing_report", "campaign_budget", _labelled("budget", _MONEY)),
        ("marketing_report", "total_impressions", _labelled("impressions", r"([\d,]+)")),
        ("marketing_report", "total_clicks", _labelled("clicks", r"([\d,]+)")),
        ("marketing_report", "click_through_rate", _labelled("click-through rate|CTR", _PERCENT)),
        ("marketing_report", "conversion_rate", _labelled("conversion rate", _PERCENT)),
        ("marketing_report", "cost_per_acquisition", _labelled("cost per (?:acquisition|lead)|CPA", _MONEY)),
        ("marketing_report", "roi_percent", _labelled("return on investment|ROI", _PERCENT)),
        ("hr_policy", "effective_date", _labelled("effective(?: date)?", _DAY)),
        ("hr_policy", "version_number", _labelled("version|revision", r"(\d+(?:\.\d+)*)")),
        ("hr_policy", "department", _labelled("department", _NAME)),
        ("hr_policy", "approval_authority", _labelled("approved by", _NAME)),
        ("hr_policy", "last_review_date", _labelled("last reviewed", _DAY)),
        ("corporate_policy", "policy_name", _labelled("policy(?: name)?", _NAME)),
        ("corporate_policy", "effective_date", _labelled("effective(?: date)?", _DAY)),
        ("corporate_policy", "approval_date", _labelled("approv(?:ed|al)(?: date| on)?", _DAY)),
        ("corporate_policy", "policy_owner", _labelled("policy owner|owner", _NAME)),
        ("corporate_policy", "spending_limits", _labelled("(?:spending )?limit", _MONEY)),
        ("corporate_policy", "review_frequency", r"(?i)reviewed (annually|quarterly|monthly)"),
        ("financial_infographic", "quarter", r"\b(Q[1-4])\b"),
        ("financial_infographic", "fiscal_year", _labelled("fiscal(?: year)?|FY", r"(\d{4})")),
        ("financial_infographic", "revenue", _labelled("revenue", _MONEY)),
        ("financial_infographic", "revenue_growth_percent", _labelled("revenue growth", _PERCENT)),
        ("financial_infographic", "operating_margin", _labelled("operating margin", _PERCENT)),
        ("financial_infographic", "net_income", _labelled("net income", _MONEY)),
        ("financial_infographic", "customers_count", _labelled("total customers|customers", r"([\d,]+)")),
        ("financial_infographic", "net_revenue_retention_rate", _labelled("net revenue retention(?: rate)?", _PERCENT)),
        ("financial_infographic", "gross_margin", _labelled("gross margin", _PERCENT)),
        ("case_study", "customer_name", _labelled("customer", _NAME)),
        ("case_study", "industry", _labelled("industry", _NAME)),
        ("case_study", "implementation_duration", r"(?i)(\d+ (?:weeks|months|days))"),
        ("case_study", "testimonial_quote", r"[\"“]([^\"”]{20,400})[\"”]"),
        ("strategy_document", "planning_period", r"\b(Q[1-4]-Q[1-4] \d{4}|FY ?\d{4}|20\d{2})\b"),
        ("strategy_document", "department", _labelled("department", _NAME)),
        ("strategy_document", "budget_allocation", _labelled("budget", _MONEY)),
        ("strategy_document", "document_date", _labelled("date|published", _DAY)),
        ("other", "document_title", r"(?m)\A\s*(.{3,120})$"),
        ("other", "document_date", _DAY),
    )
)
