"""Rule data validation, parametrised over the registry (the reference's
registry contract tests, re-aimed at the rule records and the rule table)."""

import re

import pytest

from sluice.rules import DIRECTORY_RULES, RULE_SCHEMA, get_rule, rule_alias_frame, rules_frame

RULES = list(DIRECTORY_RULES)


@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.key)
def test_rule_record(rule):
    vals = rule.qualifying_udf_values
    assert vals and len(set(vals)) == len(vals)
    assert all(re.fullmatch(r"[0-9]{5}", v) for v in vals)          # code-list audit: 5-digit codes
    assert rule.trigger_field and rule.trigger_value and rule.udf_field_name
    assert rule.candidate_identity_columns and all(rule.candidate_identity_columns)
    assert rule.outbound_identity_map and all(a and b for a, b in rule.outbound_identity_map)
    assert rule.outbound_prefix.endswith("/") and not rule.outbound_prefix.startswith("/")
    assert rule.final_key_columns and rule.final_column and rule.final_expected_values
    assert str(rule.rule_id) in rule.rule_ids_accepted
    assert get_rule(rule.key) is rule


def test_rule_ids_are_not_keys():
    # two registered rules share id 15; the key (and the flow) tell them apart
    assert len({r.rule_id for r in RULES}) < len(RULES)
    assert len({(r.flow_name, r.rule_id) for r in RULES}) == len(RULES)


def test_rule_tables(spark):
    df = rules_frame(spark, RULES)
    assert df.schema == RULE_SCHEMA and df.count() == len(RULES)
    aliases = rule_alias_frame(spark, RULES)
    assert aliases.count() == sum(len(r.rule_ids_accepted) for r in RULES)
