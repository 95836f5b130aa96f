"""The registered queries of this subpackage, by name, and their SQL."""

from . import (contexttree, decontaminate, fim, hosts, maintext, negatives, packing, quality, quantised, simhash, suffixes,
               topk, warc)

QUERIES = {
    "op1_topk": topk.op1_topk,
    "op2_warc": warc.op2_warc,
    "op3_suffix_array": suffixes.op3_suffix_array,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_packing": packing.op5_packing,
    "op6_quality": quality.op6_quality,
    "op7_hosts": hosts.op7_hosts,
    "op8_main_text": maintext.op8_main_text,
    "op9_context_tree": contexttree.op9_context_tree,
    "op10_simhash": simhash.op10_simhash,
    "op11_negatives": negatives.op11_negatives,
    "op12_quantised": quantised.op12_quantised,
    "op13_fill_in_middle": fim.op13_fill_in_middle,
}

ORACLES = {
    "op1_topk": topk.ORACLE,
    "op2_warc": warc.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
    "op7_hosts": hosts.ORACLE,
    "op11_negatives": negatives.ORACLE,
    "op12_quantised": quantised.ORACLE,
    "op13_fill_in_middle": fim.ORACLE,
}
