"""One ANSI-SQL statement per registered query."""

from oracles.views import with_views as q

HISTORY_REJECTS = """
    select 'backfill_history' step,
           case status when 'NO_BANK' then '000325' when 'NO_RATE' then '000376' else '000303' end code,
           '*Other' kind, 'INFO' as level, h43kmv as key,
           status || ': ' || case status
               when 'NO_BANK' then 'no single bank ' || prtban
               when 'NO_RATE' then 'no single rate for cover ' || h43ggi || ', country ' || bqeptx || ', company ' || prtcie
               else 'no single loan for movement ' || h43kmv end message,
           case when status = 'AMBIGUOUS_LOAN' then -811 else 100 end rc
    from h43_rated where status <> 'OK'"""

SUMMARY = """
    select count(*) n_read, count(*) filter (status = 'OK') n_updated, count(*) filter (status <> 'OK') n_failed,
           case when count(*) filter (status <> 'OK') = 0 then '00' else '01' end as level from {}"""

NET = "cast(cast(sign(c) * ((2000 * abs(c) + m) // (2 * m)) as decimal(13,0)) * 0.01::decimal(3,2) as decimal(11,2))"

PRIORITY_TABLE = """
    select packro, pacggi, pacmpa, pacdep,
           coalesce(pactau, case when packro in (select idpret from prio where traite = 'N') and status = 'OK'
                                 then tau end) pactau
    from pac_rated"""

ORACLES = {
    # ---- sources and sinks
    "scan_typed": q(
        """select h43dmo "C_dateModification", h43mpb "C_montantPalier_Avant", h43deb "C_dateEffetPalier_Avant",
                  h43nli "P_numeroLigne", h43kmv "X_idHistoMouvement", h43ggi "F_idGarGarantieIncluse",
                  h43tau "C_taux", h43mtx "C_montantTaxe", h43mht "C_montantHt", h43pro "F_profil" from h43""",
        "h43",
    ),
    "scan_full": "select * from orders",
    "stage_overwrite": q("select * from mvt where madkmv % 3 = 0", "mvt"),
    "insert_select": q(
        """select idpret, traite, cast(null as date) "dateTraite" from prio where traite = 'N'
           union all select prtkro, null, prtdrt from loan where prtmot = '2-HIGH'""",
        "prio",
        "loan",
    ),
    "insert_values": q(
        """select * from prio union all values (4295327, 'N'), (4295351, 'N'), (4296188, 'N')""", "prio"
    ),
    "reject_log": q(HISTORY_REJECTS, "h43_rated"),
    "log_by_day": q("select * from log where cast(logdhe as date) = date '2024-01-15' order by logdhe desc", "log"),
    # ---- projections, filters, predicates
    "project_cols": q("select packro, pacggi, pactau from pac", "pac"),
    "computed_age": q("select empno, lastname, cast(2020 - year(birthdate) as int) age from emp", "emp"),
    "filter_conj": q("select * from rate where x_ciecode = 1 and f_idpays = 7 and taxgar = 3", "rate"),
    "worklist_null": q("select h43ggi, h43kmv from h43 where h43tau is null order by h43kmv", "h43"),
    "filter_not_null": q("select h43ggi, h43kmv, h43tau from h43 where h43tau is not null", "h43"),
    "filter_param": q(
        """select packro, pacggi, pacdep from pac
           where pacggi = 3 and pactau is null and pacdep >= date '1998-01-01'""",
        "pac",
    ),
    "filter_sentinel": q("select corkro, cornat, cordat from cor where cordte = date '0001-01-01'", "cor"),
    "filter_zero_rate": q("select packro, pacggi, pactau from pac where pactau = 0", "pac"),
    "decision_diff": q(
        """select gdekro, gdekrh, gdegar, gdecdc, dectdp from egde join sr on decoba = gdekro + 3000000 and decgar = gdegar
           where n = 1 and coalesce(gdecdc, 0) <> coalesce(dectdp, 0)""",
        "egde",
        "sr",
    ),
    "filter_blank": q("select laekro from elae where trim(substr(laeref, 13, 11)) = ''", "elae"),
    # ---- joins
    "join_inner": q("select madkmv, prtcie, prtdrt, prtban from mvt join loan on madkro = prtkro", "mvt", "loan"),
    "join_bucketed": q(
        """select h43kmv, h43nli, h43ggi, madkro
           from h43 left join (select madkmv, max(madkro) madkro from mvt group by madkmv having count(*) = 1) on h43kmv = madkmv""",
        "h43",
        "mvt",
    ),
    "join_composite": q(
        """select corkro, prtkro, cordat, prtres from cor
           join loan on cornum = prtnum and corord = prtord""",
        "cor",
        "loan",
    ),
    "join_threeway": q(
        """select prtcie, prtban, h43ggi, prtdrt from h43 join mvt on h43kmv = madkmv join loan on madkro = prtkro
           where h43tau is null""",
        "h43",
        "mvt",
        "loan",
    ),
    "join_left": q("select packro, pactau, madkmv from pac left join mvt on packro = madkmv", "pac", "mvt"),
    "join_anti": q(
        "select corkro, cornat from cor where not exists (select * from csu where csukro = corkro)", "cor", "csu"
    ),
    "join_semi_exists": q(
        "select * from adh where exists (select * from egde where gdekro = adhkro)", "adh", "egde"
    ),
    "join_semi_in": q(
        "select gdekro, gdekrh, gdegar from egde where gdekro in (select adhkro from adh where adhcor = 4)",
        "adh",
        "egde",
    ),
    "scalar_subquery": q(
        """select e.empno, case when n = 1 then w end wage,
                  case when n is null then 'NOT_FOUND' when n > 1 then 'AMBIGUOUS' else 'OK' end status
           from emp e left join (select empno, count(*) n, max(salary) w from wage group by empno) x
             on e.empno = x.empno""",
        "emp",
        "wage",
    ),
    "lookup_checked": q(
        """select h43kmv, h43ggi, case when n = 1 then prtcie end prtcie, case when n = 1 then prtban end prtban,
                  case when n = 1 then prtdrt end prtdrt,
                  case when n is null then 'NOT_FOUND' when n > 1 then 'AMBIGUOUS' else 'OK' end status
           from h43 left join mvt_loan on h43kmv = madkmv where h43tau is null""",
        "h43",
        "mvt_loan",
    ),
    "rate_asof": q(
        """select packro, pacggi, prtdrt, tau, case when tau is null then 100 else 0 end rc
           from pac_rated where status in ('OK', 'NO_RATE')""",
        "pac_rated",
    ),
    "worklist_detail": q(
        """select pacggi, packro from pac
           where pactau is null and packro in (select idpret from prio where traite = 'N')""",
        "pac",
        "prio",
    ),
    "latest_batch": q(
        "select gdekro, gdekrh, gdegar, gdecdc from egde join top on gdekro = topkro and gdekrh = topkrh", "egde", "top"
    ),
    # ---- aggregations
    "count_all": q("select count(*) n from h43", "h43"),
    "check_exactly_one": q(
        """select ciecie, count(*) filter (cieban = 0) n, count(*) filter (cieban = 0) = 1 ok
           from cie group by ciecie""",
        "cie",
    ),
    "validate_params": q(
        """select prm_id, parameter, '001227' code, 'WARN' as level, 'parametre ' || parameter || ' invalide' message
           from (select p.*, case
                   when option = '*del' then 'option'
                   when option = '*ano' and try_cast(quantite as decimal(8,0)) is null then 'quantite'
                   when (select count(*) from cie where ciecie = try_cast(compagnie as decimal(3,0)) and cieban = 0) <> 1
                     then 'compagnie' end parameter from prm p)
           where parameter is not null""",
        "prm",
        "cie",
    ),
    "group_max": q('select gdekro, max(gdekrh) "derkroDec" from egde group by gdekro', "egde"),
    "list_agg_fixed": q(
        """select gdekro, substr(string_agg(gdegar || '/', '' order by gdegar, gdecdc nulls last, gdekrh), 1, 20) covers,
                  substr(string_agg(coalesce(cast(gdecdc as varchar), '-') || '/', ''
                         order by gdegar, gdecdc nulls last, gdekrh), 1, 20) decisions,
                  substr(string_agg((gdekrh % 10000) || '/', '' order by gdegar, gdecdc nulls last, gdekrh), 1, 20) batches
           from egde group by gdekro""",
        "egde",
    ),
    "pivot_exclusions": q("select excdec, excgar, excoba, n1 gdecn1, n2 gdecn2, n3 gdecn3 from codes", "codes"),
    "group_flags": q(
        """select gdekro, bool_or(gdecdc is null) any_null, coalesce(bool_or(gdecdc = 3), false) any_refused,
                  bool_or(gdegar = 0) any_cover_zero from egde group by gdekro""",
        "egde",
    ),
    "batch_summary": q(SUMMARY.format("h43_rated"), "h43_rated"),
    "updates_per_loan": q(
        """select packro, count(*) filter (status = 'OK') n_updated from pac_rated
           where pactau is null and packro in (select idpret from prio where traite = 'N') group by packro""",
        "pac_rated",
        "prio",
    ),
    # ---- sort, limit, top-k
    "sort_single": q("select h43ggi, h43kmv from h43 where h43tau is null order by h43kmv nulls last, h43ggi", "h43"),
    "sort_multi": q("select packro, pacdep, pacggi from pac order by packro, pacdep, pacggi", "pac"),
    "sort_desc": q("select empno, birthdate from emp order by birthdate desc nulls first, empno", "emp"),
    "sort_verified": q(
        """select (select count(*) from pac) n, a.packro, a.pacdep, a.pacggi, b.packro last_packro, b.pacdep last_pacdep,
                  b.pacggi last_pacggi, cast(0 as bigint) broken
           from (select packro, pacdep, pacggi from pac order by packro, pacdep desc nulls first, pacggi limit 1) a,
                (select packro, pacdep, pacggi from pac order by packro desc nulls first, pacdep, pacggi desc nulls first limit 1) b""",
        "pac",
    ),
    "limit_n": q(
        "select h43kmv, h43ggi, h43mpb from h43 where h43tau is null order by h43kmv, h43ggi, h43mpb limit 1000", "h43"
    ),
    "limit_large": q(
        "select h43kmv, h43ggi, h43mpb from h43 where h43tau is null order by h43kmv, h43ggi, h43mpb limit 5000", "h43"
    ),
    "top_k": q(
        """select empno, lastname, firstnme, birthdate from emp
           order by birthdate desc nulls first, empno limit 200""",
        "emp",
    ),
    # ---- table changes
    "fill_rate": q("select packro, pacggi, pacmpa, coalesce(pactau, tau) pactau from pac_rated", "pac_rated"),
    "update_keyed": q(
        """select gdekro, gdekrh, gdegar, case when decoba is null then gdecdc else newcdc end gdecdc
           from egde left join (select decoba, decgar, arg_max_null(dectdp, decdec) newcdc
                                from mdec group by decoba, decgar)
             on decoba = gdekro + 3000000 and decgar = gdegar""",
        "egde",
        "mdec",
    ),
    "mark_processed": q("select idpret, case traite when 'N' then 'O' else traite end traite from prio", "prio"),
    "reset_null": q("select h43kmv, h43ggi, cast(null as decimal(5,3)) h43tau from h43", "h43"),
    "set_constant": q("select idpret, 'N' traite from prio", "prio"),
    "status_update": q(
        """select adhkro "kronoAdh",
                  case when gde_found and not sr_found then 'not found' end "decisionSR",
                  case when not gde_found then 'not found' end "decisionGDE",
                  case when not gde_found or not sr_found then 'N' end "rechercheAno",
                  case when sr_found and wrong then 'O' end "correctionAno",
                  case when sr_found and wrong then timestamp '2020-06-03 12:00:00' end "dateModif"
           from (select adhkro, fkro is not null gde_found, coalesce(sr_found, false) sr_found, wrong
                 from adh join (select laekro, try_cast(substr(laeref, 13, 11) as bigint) lob from elae) on laekro = adhkro
                 left join (select kronoAdh fkro, numObaSR fob, bool_or(found = 'OK') sr_found,
                                bool_or((found = 'OK' and gde <> sr) or (found = 'NOT_FOUND' and gde <> 0)) wrong
                              from cmp group by kronoAdh, numObaSR) on fkro = adhkro and fob is not distinct from lob
                 where adhcor = 4)""",
        "cmp",
        "adh",
        "elae",
    ),
    "copy_column": q("select corkro, cornat, corkro corkrg from cor", "cor"),
    "update_from_table": q(
        """select e.empno, lastname, case when n = 1 then w else e.salary end salary
           from emp e left join (select empno, count(*) n, max(salary) w from wage group by empno) x
             on e.empno = x.empno""",
        "emp",
        "wage",
    ),
    "touch_changed": q(
        """select packro, pacggi, cast(null as decimal(5,3)) pactau,
                  case when pactau is not null then timestamp '2020-06-03 12:00:00' else pacdmo end pacdmo
           from pac""",
        "pac",
    ),
    "publish_atomic": q(f"select packro, pacggi, pactau from ({PRIORITY_TABLE})", "pac_rated", "prio"),
    "archive_modified": q(
        """select adhcie compagnie, adhkro "kronoAdh", cast(null as varchar) garantie,
                  cast(null as varchar) "correctionAno", cast(null as timestamp) "dateModif" from adh where adhcor = 1
           union all select compagnie, kronoAdh, garantie, corr, stamp from corrected where stamp is not null""",
        "adh",
        "corrected",
    ),
    "check_pk": q("select h43nli, h43kmv, count(*) n from h43 group by h43nli, h43kmv having count(*) > 1", "h43"),
    "check_fk": q(
        """select prtkro, prtban from loan
           where prtban is not null and not exists (select * from bank where bqeban = prtban)""",
        "loan",
        "bank",
    ),
    "check_not_null": q(
        " union all ".join(
            f"select '{c}' column_name, count(*) filter ({c} is null) n_null from pac"
            for c in ("pacpac", "pacdep", "pacdmo", "packro", "pacggi", "pacmpa", "pactau", "pacmht")
        ),
        "pac",
    ),
    # ---- scalar functions
    "fn_ifnull": q(
        "select decdec, coalesce(dectdp, 0) dectdp, coalesce(decdat, date '0001-01-01') decdat from mdec", "mdec"
    ),
    "fn_substr": q("select laekro, substr(laeref, 1, 11) request, substr(laeref, 13, 11) ob from elae", "elae"),
    "fn_try_decimal": q(
        """select laekro, try_cast(substr(laeref, 13, 11) as bigint) ob,
                  case when regexp_full_match(trim(substr(laeref, 9, 6)), '[0-9]+')
                       then cast(trim(substr(laeref, 9, 6)) as decimal(6,0)) end malformed from elae""",
        "elae",
    ),
    "fn_date8": q(
        """select corkro, cast(year(cordat) * 10000 + month(cordat) * 100 + day(cordat) as int) cordat8,
                  case when cordte = date '0001-01-01' then 0
                       else cast(year(cordte) * 10000 + month(cordte) * 100 + day(cordte) as int) end cordte8
           from cor""",
        "cor",
    ),
    "fn_to_date": q("select key, cast(logdhe as date) as day, cast(logdhe as date) parsed from log", "log"),
    "fn_tax_factor": q(
        """select h43kmv, h43ggi, cast((1000 + t // 100) * 0.001::decimal(4,3) as decimal(5,3)) factor,
                  cast((1000 + (t + h43kmv % 1000) // 100) * 0.001::decimal(4,3) as decimal(5,3)) fine_factor
           from (select *, cast(h43tau * 1000 as bigint) t from h43 where h43tau is not null)""",
        "h43",
    ),
    "split_net_tax": q(
        f"""select packro, pacggi, pacmpa, {NET} net, cast(pacmpa - {NET} as decimal(11,2)) tax
            from (select *, 1000 + (cast(pactau * 1000 as bigint) + packro % 1000) // 100 m,
                         cast(pacmpa * 100 as bigint) c
                  from pac where pactau is not null and pacmpa is not null)""",
        "pac",
    ),
    "fn_message": q(
        """select h43kmv, h43nli, rtrim(substr('idpret: ' || h43kmv || ' pacggi: ' || h43ggi || ' h43tau: ' ||
                  coalesce(cast(h43tau as varchar), '') || '.', 1, 50)) line, rpad(h43pro, 10, ' ') profile from h43""",
        "h43",
    ),
    "fn_case": q(
        """select excdec, excord, case excord when 1 then 'gdecn1' when 2 then 'gdecn2' when 3 then 'gdecn3'
                  else 'ignored' end slot from exc""",
        "exc",
    ),
    "rate_rule": q(
        """select packro, pacggi,
                  cast(case when prtdrt < date '1999-01-01' and pacggi = 3 then 0 else 9 end as decimal(5,3)) rate
           from pac join loan on packro = prtkro""",
        "pac",
        "loan",
    ),
    # ---- jobs
    "job_backfill_history": q(
        """select h43kmv, h43nli, h43ggi, h43mpb, h43deb, h43tau from h43 where h43tau is not null
           union all select h43kmv, h43nli, h43ggi, h43mpb, h43deb, case when status = 'OK' then tau end
           from h43_rated""",
        "h43_rated",
    ),
    "job_backfill_history_limited": q(
        """select h43kmv, h43nli, h43ggi, h43tau from h43 where h43tau is not null
           union all select h43kmv, h43nli, h43ggi, case when status = 'OK' and picked then tau end
           from (select *, row_number() over (order by h43kmv, h43nli, h43ggi) <= 5000 picked from h43_rated)""",
        "h43_rated",
    ),
    "job_backfill_history_rejects": q(HISTORY_REJECTS, "h43_rated"),
    "job_backfill_priority": q(PRIORITY_TABLE, "pac_rated", "prio"),
    "job_backfill_priority_summary": q(
        SUMMARY.format(
            """(select * from pac_rated where pactau is null
                and packro in (select idpret from prio where traite = 'N'))"""
        ),
        "pac_rated",
        "prio",
    ),
    "job_priority_flags": q("select idpret, 'O' traite from prio", "prio"),
    "job_priority_flags_clean": q(
        """select idpret, case when traite = 'N' and idpret in
                  (select packro from pac_rated where pactau is null and status <> 'OK') then 'N' else 'O' end traite
           from prio""",
        "prio",
        "pac_rated",
    ),
    "job_split_net_tax": q(
        f"""select packro, pacggi, pacmpa, pacmht, pacmtx, pacpro from pac where pacmht is not null
            union all
            select packro, pacggi, pacmpa, case when split_status = 'OK' then {NET} end,
                   case when split_status = 'OK' then cast(pacmpa - {NET} as decimal(11,2)) else pacmtx end,
                   case when split_status = 'OK' then 'A0OAV' else pacpro end
            from pac_split""",
        "pac",
        "pac_split",
    ),
    "job_split_net_tax_rejects": q(
        """select 'split_net_tax' step,
                  case split_status when 'NO_AMOUNT' then '000379' when 'NO_LOAN' then '000419' else '000458' end code,
                  case split_status when 'NO_RATE' then '*Other' else '*SQL' end kind, 'INFO' as level, packro as key,
                  split_status || ': ' || case split_status when 'NO_AMOUNT' then 'a tier of loan ' || packro || ' has no amount'
                    when 'NO_LOAN' then 'no single loan with its bank for ' || packro
                    else 'no single rate for loan ' || packro end message,
                  case split_status when 'NO_AMOUNT' then -305 else 100 end rc
           from pac_split where split_status <> 'OK'""",
        "pac_split",
    ),
    "job_split_net_tax_end": q(
        """select 'split_net_tax' step, case when n_failed = 0 then '000507' else '000515' end code, '*Other' kind,
                  'INFO' as level, cast(null as bigint) as key,
                  'tiers split: ' || n_updated || ' of ' || n_read || ' done' ||
                  case when n_failed = 0 then '' else ', ' || n_failed || ' rejected' end message,
                  cast(n_failed > 0 as int) rc
           from (""" + SUMMARY.format("(select split_status status from pac_split)") + ")",
        "pac_split",
    ),
    "job_split_net_tax_summary": q(SUMMARY.format("(select split_status status from pac_split)"), "pac_split"),
    "job_list_members": q('select compagnie, kronoAdh "kronoAdh", numDemSR "numDemSR", numObaSR "numObaSR" from members', "members"),
    "job_list_members_single_ob": q(
        """select compagnie, kronoAdh "kronoAdh", numDemSR "numDemSR", numObaSR "numObaSR" from members
           where compagnie = 1 and substr(laeref, 24, 2) <> ' 0'""",
        "members",
    ),
    "job_latest_decisions": q(
        """select topkro "derkroAdh", topkrh "derkroDec" from top
           where topkro in (select kronoAdh from members)""",
        "top",
        "members",
    ),
    "job_find_anomalies": q(
        """select kronoAdh "kronoAdh", numObaSR "numObaSR", garantie, decisionSR "decisionSR", decisionGDE "decisionGDE",
                  rechercheAno "rechercheAno", correctionAno "correctionAno" from searched""",
        "searched",
    ),
    "job_find_anomalies_limited": q(
        """select s.kronoAdh "kronoAdh", s.numObaSR "numObaSR", case when picked then garantie end garantie,
                  case when picked then decisionSR end "decisionSR", case when picked then rechercheAno end "rechercheAno"
           from (select *, row_number() over (order by kronoAdh, numObaSR nulls last) <= 60 picked from searched) s""",
        "searched",
    ),
    "job_find_anomalies_rejects": q(
        """select 'find_anomalies' step, '001401' code, '*Other' kind, 'WARN' as level, kronoAdh as key,
                  found || ': no single decision for OB ' || coalesce(cast(numObaSR as varchar), '') || ', cover ' ||
                  gdegar message, case found when 'AMBIGUOUS' then -811 else 100 end rc
           from cmp where found <> 'OK'""",
        "cmp",
    ),
    "job_correct_decisions": q(
        """select gdekro, gdekrh, gdegar, case when fixkro is null then gdedec else newdec end gdedec,
                  case when fixkro is null then gdecdc else newcdc end gdecdc,
                  case when fixkro is null then gdecn1 else n1 end gdecn1,
                  case when fixkro is null then gdecn2 else n2 end gdecn2,
                  case when fixkro is null then gdecn3 else n3 end gdecn3
           from egde left join fixes on fixkro = gdekro and fixgar = gdegar""",
        "egde",
        "fixes",
    ),
    "job_correct_rejects": q(
        """select 'correct_anomalies' step, '001401' code, '*Other' kind, 'WARN' as level, kronoAdh as key,
                  found || ': no single decision for OB ' || coalesce(cast(numObaSR as varchar), '') || ', cover ' ||
                  gdegar message, case found when 'AMBIGUOUS' then -811 else 100 end rc
           from tocorrect where found <> 'OK'
           union all
           select 'correct_anomalies', 'CONFLICT', '*Other', 'WARN', badkro,
                  'CONFLICT: the OBs of a member ask for different decisions on cover ' || badgar, -811
           from conflicts""",
        "tocorrect",
        "conflicts",
    ),
    "job_correct_members": q(
        """select kronoAdh "kronoAdh", numObaSR "numObaSR", garantie, rechercheAno "rechercheAno", corr "correctionAno", stamp "dateModif"
           from corrected""",
        "corrected",
    ),
    "job_open_letters": q(
        """select corkro, cornum, corord, cordat, prtkro, prtres, prtmot from cor
           join loan on cornum = prtnum and corord = prtord
           where cornat = 250 and cordte = date '0001-01-01' and cordat = date '1998-01-01'
             and not exists (select * from csu where csukro = corkro)
           order by cornum, corord""",
        "cor",
        "loan",
        "csu",
    ),
    "job_sync_salary": q(
        """select e.empno, lastname, case when n = 1 then w else e.salary end salary
           from emp e left join (
               select empno, count(*) n, max(salary) w from wage
               where empno in (select empno from emp order by birthdate desc nulls first, empno limit 200)
               group by empno) x on e.empno = x.empno""",
        "emp",
        "wage",
    ),
    "job_premium_report": q(
        """select h43kmv, h43nli, rtrim(substr('F_CIECODE: ' || prtcie || ' F_BANCODE: ' || prtban ||
                  ' F_IDGARGARANTIEINC: ' || h43ggi || ' C_DATEREFERENCETARIFAIRE: ' || prtdrt || '.', 1, 50)) line
           from h43 join mvt on h43kmv = madkmv join loan on madkro = prtkro where h43tau is null""",
        "h43",
        "mvt",
        "loan",
    ),
}
