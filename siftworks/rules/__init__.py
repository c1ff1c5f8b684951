from siftworks.rules.model import (  # noqa: F401
    CandidateRules, CleanRules, CommunityRules, IssueRules, MailRules,
    PostingRules, QualityRules, RemoteRules, ReportRules, StudentRules,
    UrlPatterns, WeightedRules, load_rules, phrase_list, rule_frame,
)
