"""Schema validation: declared contract, official dictionary, row-count reconciliation."""

from tamiz.contract.contract import Contract, ContractError, check_critical, contract_check, contract_summary, schema_rows
from tamiz.contract.dictionary import compare_dictionary, dictionary_summary, first_dictionary, physical_columns

__all__ = [
    "Contract",
    "ContractError",
    "check_critical",
    "compare_dictionary",
    "contract_check",
    "contract_summary",
    "dictionary_summary",
    "first_dictionary",
    "physical_columns",
    "schema_rows",
]
