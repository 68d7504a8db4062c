"""Declared schemas (DDL) of the engine's tables. Coordinates are 0-based and half-open unless a column's format says otherwise."""

RUN_METADATA = ", ".join(f"{c} string" for c in "srr_accession srx_accession srs_accession srp_accession bioproject organism strain platform instrument total_bases total_spots library_strategy library_source library_layout title".split())
INSERTIONS = "uuid string, chrom string, start bigint, end bigint, family string, subfamily string, consensus string, support bigint"
CIRCLE_SUMMARY = "is_uuid string, chrom string, start bigint, end bigint, family string, subfamily string, consensus_length bigint, consensus string, n_tail_head_reads bigint, n_genome_head_reads bigint, n_tail_genome_reads bigint, n_total_mapped bigint, example_th_read string"
BLAST6 = "qseqid string, sseqid string, pident double, length bigint, mismatch bigint, gapopen bigint, qstart bigint, qend bigint, sstart bigint, send bigint, evalue double, bitscore double, qlen bigint, slen bigint"
CLUSTER_PAIRS = "representative string, member string"
ALIGNMENTS = "query_name string, flag int, reference_name string, ref_start bigint, ref_end bigint, mapq int, cigar string, seq string, qual string"
PARTIAL_CIRCLE = "is_id string, is_length bigint, circle_start bigint, circle_end bigint, circle_size bigint, circle_fraction double, n_supporting_reads bigint, mean_mapq double, supporting_read_names array<string>"
RECORD = """is_id string, sample_id string, organism string,
is_element struct<sequence:string,length:bigint,contig:string,chrom:string,start:bigint,end:bigint,strand:string>,
flanking_upstream struct<sequence:string,length:bigint>, flanking_downstream struct<sequence:string,length:bigint>,
insertion_site struct<contig:string,pos_5p:bigint,pos_3p:bigint>,
circle_evidence struct<n_tail_head_reads:bigint,n_genome_head_reads:bigint,n_tail_genome_reads:bigint,example_th_read:string>,
assembly_method string,
orf_annotation struct<num_orfs:bigint,coding_fraction:double,
  orfs:array<struct<start:bigint,end:bigint,strand:string,length_nt:bigint,protein_sequence:string,confidence:double,domains:array<string>>>,
  noncoding_regions:array<struct<start:bigint,end:bigint,length:bigint,type:string>>>,
guide_hits array<struct<flanking_source:string,noncoding_region_index:int,noncoding_region_type:string,noncoding_start:bigint,noncoding_end:bigint,
  pos_in_flanking:bigint,pos_in_noncoding:bigint,length:bigint,orientation:string,mismatches:int,mismatch_positions:array<int>,seq_flanking:string,seq_noncoding:string>>,
guide_summary struct<n_hits:bigint,best_length:bigint,has_revcomp_hit:boolean>,
isfinder_annotation struct<best_hit_name:string,best_hit_family:string,best_hit_group:string,pident:double,query_coverage:double,evalue:double,bitscore:double,
  all_hit_families:array<string>,all_hit_names:array<string>,is_multi_family:boolean,n_hits:bigint>"""
