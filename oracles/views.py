"""The derived input tables as SQL, for use as common table expressions."""

VIEWS = {
    "loan": """
        select o_orderkey prtkro, cast(o_custkey % 5 as int) prtcie, o_custkey prtban,
               cast(o_orderdate as date) prtdrt, o_orderkey // 10 prtnum, o_orderkey % 10 prtord,
               o_orderstatus prtres, o_orderpriority prtmot
        from orders""",
    "bank": "select c_custkey bqeban, c_nationkey bqeptx from customer where c_custkey % 40 <> 0",
    "mvt": """
        select o_orderkey * 2 madkmv, o_orderkey madkro from orders where o_orderkey % 50 <> 0
        union all select o_orderkey * 2, o_orderkey from orders where o_orderkey % 50 = 1""",
    "rate": """
        select cast(cie as int) x_ciecode, n_nationkey f_idpays, cast(gar as int) taxgar,
               make_date(1994 + 2 * k, 1, 1) valid_from,
               cast(((cie * 37 + n_nationkey * 61 + gar * 17 + k * 13) % 160) * 0.125 as decimal(5,3)) tau
        from nation, range(5) a(cie), range(1, 8) b(gar), range(1, 4) d(k)
        where not (gar = 7 and n_nationkey % 5 = 0)""",
    "h43": """
        select l_shipdate h43dmo, cast(l_extendedprice as decimal(11,2)) h43mpb, cast(l_shipdate as date) h43deb,
               l_linenumber h43nli, l_orderkey * 2 h43kmv, l_linenumber h43ggi,
               case when l_returnflag = 'R' then null else cast(l_tax * 100 as decimal(5,3)) end h43tau,
               case when l_linestatus = 'O' then null else cast(l_quantity as decimal(11,2)) end h43mtx,
               cast(l_extendedprice as decimal(11,2)) h43mht, l_returnflag h43pro
        from lineitem""",
    "pac": """
        select l_orderkey * 10 + l_linenumber pacpac,
               case when l_orderkey % 29 = 0 and l_linenumber >= 5 then null
                    else cast(l_extendedprice as decimal(11,2)) end pacmpa,
               cast(l_shipdate as date) pacdep, l_shipdate pacdmo, l_orderkey packro, l_linenumber pacggi,
               case when l_returnflag = 'R' then null else cast(l_tax * 100 as decimal(5,3)) end pactau,
               cast(null as decimal(11,2)) pacmtx,
               case when l_linestatus = 'O' then null else cast(l_extendedprice as decimal(11,2)) end pacmht,
               l_returnflag pacpro
        from lineitem""",
    "prio": """
        select o_orderkey idpret, case when o_orderpriority = '1-URGENT' then 'N' else 'O' end traite
        from orders where o_orderpriority in ('1-URGENT', '2-HIGH')""",
    "adh": """
        select c_custkey adhkro, c_nationkey % 3 adhcie,
               case when c_mktsegment = 'BUILDING' then 1 else 4 end adhcor
        from customer""",
    "elae": """
        select c_custkey laekro, lpad(cast(c_custkey + 2000000 as varchar), 11, '0') ||
               case when c_custkey % 33 = 0 then repeat(' ', 12)
                    else ' ' || lpad(cast(c_custkey + 3000000 as varchar), 11, '0') end ||
               case when c_custkey % 47 = 5 then ' ' || lpad(cast(c_custkey + 3000000 as varchar), 11, '0')
                    else '' end laeref
        from customer
        union all
        select c_custkey, lpad(cast(c_custkey + 2000000 as varchar), 11, '0') || ' ' ||
               lpad(cast(c_custkey + 3000001 as varchar), 11, '0')
        from customer where c_custkey % 13 = 3""",
    "egde": """
        select o_custkey gdekro, o_custkey * 10000 + year(o_orderdate) gdekrh, cast(o_orderkey % 5 as int) gdegar,
               case when o_orderkey % 7 = 0 then null else cast(o_orderkey % 4 as int) end gdecdc,
               cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as int) gdedec,
               cast(o_orderkey % 3 as int) gdecn1, 0 gdecn2, 0 gdecn3
        from orders where o_custkey % 20 <> 0""",
    "mdec": """
        select o_orderkey decdec, o_custkey + 3000000 decoba, cast(o_orderkey % 5 as int) decgar,
               case when o_orderkey % 11 = 0 then null else cast(o_orderdate as date) end decdat,
               case when o_orderkey % 9 = 0 then null else cast(o_orderkey % 4 as int) end dectdp
        from orders where o_orderstatus <> 'P' and o_custkey % 25 <> 1""",
    "ddo_once": """
        select max(o_orderkey) ddodec, o_custkey + 3000000 ddooba
        from orders where o_orderstatus <> 'P' and o_custkey % 25 <> 1
        group by o_custkey, o_orderkey % 5""",
    "ddo": "select * from ddo_once union all select * from ddo_once where ddodec % 97 = 0",
    "exc": """
        select l_orderkey excdec, cast(l_orderkey % 5 as int) excgar, o_custkey + 3000000 excoba,
               l_linenumber excord, cast(l_partkey % 100 as int) exccod
        from lineitem join orders on l_orderkey = o_orderkey""",
    "cor": """
        select o_orderkey corkro, o_orderkey // 10 cornum, o_orderkey % 10 corord,
               case when o_orderpriority = '1-URGENT' then 250 else 100 end cornat,
               case when o_orderstatus = 'O' then date '0001-01-01' else cast(o_orderdate as date) end cordte,
               make_date(year(o_orderdate), 1, 1) cordat
        from orders""",
    "csu": "select distinct l_orderkey csukro from lineitem where l_returnflag = 'A'",
    "cie": "select cast(c_custkey % 700 as int) ciecie, cast((c_custkey // 700) % 2 as int) cieban from customer",
    "prm": """
        select c_custkey prm_id,
               case c_custkey % 4 when 0 then '*lst' when 1 then '*ano' when 2 then '*upd' else '*del' end as option,
               case when c_custkey % 5 = 0 then '    ' when c_custkey % 7 = 0 then 'A12 '
                    else cast(c_custkey % 900 as varchar) end compagnie,
               case when c_custkey % 6 = 0 then '' when c_custkey % 11 = 0 then '12x'
                    else cast(c_custkey as varchar) end quantite
        from customer""",
    "emp": """
        select c_custkey empno, c_name lastname, c_mktsegment firstnme,
               case when c_custkey % 50 = 0 then null
                    else date '1960-01-01' + cast((c_custkey * 37) % 12000 as int) end birthdate,
               cast(c_acctbal as decimal(11,2)) salary
        from customer""",
    "wage": """
        select s_suppkey empno, cast(s_acctbal as decimal(11,2)) salary from supplier
        union all select s_suppkey, cast(s_acctbal as decimal(11,2)) from supplier where s_suppkey % 50 = 7""",
    "log": "select ts logdhe, event_type code, event_id key, value rc from events",
    # movement -> loan, counted
    "mvt_loan": """
        select madkmv, count(*) n, max(prtcie) prtcie, max(prtban) prtban, max(prtdrt) prtdrt
        from mvt join loan on madkro = prtkro group by madkmv""",
    # open history rows with the first failing lookup of the chain
    "h43_rated": """
        select h.*, m.prtcie, m.prtban, m.prtdrt, b.bqeptx, r.tau,
               case when m.n is null then 'NO_LOAN' when m.n > 1 then 'AMBIGUOUS_LOAN'
                    when b.bqeban is null then 'NO_BANK' when r.tau is null then 'NO_RATE' else 'OK' end status
        from (select * from h43 where h43tau is null) h
        left join mvt_loan m on h43kmv = madkmv
        left join bank b on m.n = 1 and prtban = bqeban
        asof left join rate r on prtcie = x_ciecode and bqeptx = f_idpays and h43ggi = taxgar
                              and prtdrt >= valid_from""",
    "pac_rated": """
        select p.*, l.prtcie, l.prtban, l.prtdrt, b.bqeptx, r.tau,
               case when l.prtkro is null then 'NO_LOAN' when b.bqeban is null then 'NO_BANK'
                    when r.tau is null then 'NO_RATE' else 'OK' end status
        from pac p left join loan l on packro = prtkro left join bank b on prtban = bqeban
        asof left join rate r on prtcie = x_ciecode and bqeptx = f_idpays and pacggi = taxgar
                              and prtdrt >= valid_from""",
    # factor in thousandths, truncated; net in cents, half up, in integers
    "pac_split": """
        select *, case when pacmpa is null then 'NO_AMOUNT' when status in ('NO_LOAN', 'NO_BANK') then 'NO_LOAN'
                       else status end split_status,
               1000 + cast(cast(tau * 1000 as bigint) // 100 as bigint) m, cast(pacmpa * 100 as bigint) c
        from pac_rated where pacmht is null""",
    "members": """
        select adhcie compagnie, adhkro kronoAdh, cast(substr(laeref, 1, 11) as bigint) numDemSR,
               try_cast(substr(laeref, 13, 11) as bigint) numObaSR, laeref
        from adh join elae on adhkro = laekro
        where adhcor = 4 and exists (select * from egde where gdekro = adhkro)""",
    "sr": """
        select decoba, decgar, count(*) n, max(decdec) decdec, max(decdat) decdat, max(dectdp) dectdp
        from mdec join ddo on ddodec = decdec and ddooba = decoba group by decoba, decgar""",
    "top": "select gdekro topkro, max(gdekrh) topkrh from egde group by gdekro",
    # latest covers of the members beside the reference system
    "cmp": """
        select kronoAdh, numObaSR, gdegar, coalesce(gdecdc, 0) gde, coalesce(dectdp, 0) sr,
               case when n is null then 'NOT_FOUND' when n > 1 then 'AMBIGUOUS' else 'OK' end found,
               decdec, decdat
        from members join top on kronoAdh = topkro join egde on gdekro = topkro and gdekrh = topkrh
        left join sr on decoba = numObaSR and decgar = gdegar""",
    "listed": "select * from cmp where found = 'NOT_FOUND' or (found = 'OK' and gde <> sr)",
    "lists": """
        select kronoAdh lkro, numObaSR lob,
               substr(string_agg(gdegar || '/', '' order by gdegar, sr_key nulls last, gde), 1, 20) g,
               substr(string_agg(case when found = 'OK' then cast(sr as varchar) else '-' end || '/', ''
                      order by gdegar, sr_key nulls last, gde), 1, 20) s,
               substr(string_agg(gde || '/', '' order by gdegar, sr_key nulls last, gde), 1, 20) d
        from (select *, case when found = 'OK' then sr end sr_key from listed)
        group by kronoAdh, numObaSR""",
    "searched": """
        select m.kronoAdh, numObaSR, compagnie, numDemSR,
               case when f.sr_found then g end garantie,
               case when not f.sr_found then 'not found' else s end decisionSR,
               case when f.sr_found then d end decisionGDE,
               case when f.sr_found then 'O' else 'N' end rechercheAno,
               case when f.sr_found and g is null then 'N' end correctionAno
        from members m
        join (select kronoAdh fkro, numObaSR fob, bool_or(found = 'OK') sr_found from cmp group by kronoAdh, numObaSR) f
          on fkro = m.kronoAdh and fob is not distinct from numObaSR
        left join lists on lkro = m.kronoAdh and lob is not distinct from numObaSR""",
    "tocorrect": """
        select c.* from cmp c
        join searched s on s.kronoAdh = c.kronoAdh and s.numObaSR is not distinct from c.numObaSR
        where garantie is not null and rechercheAno = 'O' and correctionAno is null""",
    "wrong": """
        select * from tocorrect
        where ((found = 'OK' and gde <> sr) or (found = 'NOT_FOUND' and gde <> 0))""",
    "codes": """
        select excdec, excgar, excoba, coalesce(max(case when excord = 1 then exccod end), 0) n1,
               coalesce(max(case when excord = 2 then exccod end), 0) n2,
               coalesce(max(case when excord = 3 then exccod end), 0) n3
        from exc group by excdec, excgar, excoba""",
    # what the OBs of a member ask for; more than one row for a cover is a conflict
    "asked": """
        select distinct kronoAdh fixkro, gdegar fixgar,
               case when found <> 'OK' or decdat is null or decdat = date '0001-01-01' then 0
                    else cast(year(decdat) * 10000 + month(decdat) * 100 + day(decdat) as int) end newdec,
               case when found = 'OK' then sr else 0 end newcdc,
               coalesce(n1, 0) n1, coalesce(n2, 0) n2, coalesce(n3, 0) n3
        from wrong left join codes on found = 'OK' and excdec = decdec and excgar = gdegar and excoba = numObaSR""",
    "conflicts": "select fixkro badkro, fixgar badgar from asked group by fixkro, fixgar having count(*) > 1",
    "fixes": "select * from asked where not exists (select * from conflicts where badkro = fixkro and badgar = fixgar)",
    "corrected": """
        select s.*, case when done then 'O' else correctionAno end corr,
               case when done then timestamp '2020-06-03 12:00:00' end stamp
        from searched s
        left join (select kronoAdh wkro, numObaSR wob, bool_and(badkro is null) done
                   from wrong left join conflicts on badkro = kronoAdh and badgar = gdegar group by kronoAdh, numObaSR)
          on wkro = kronoAdh and wob is not distinct from numObaSR""",
}

# what each view reads, in the order the expressions must be declared
NEEDS = {
    "ddo": ["ddo_once"],
    "mvt_loan": ["mvt", "loan"],
    "h43_rated": ["h43", "mvt_loan", "bank", "rate"],
    "pac_rated": ["pac", "loan", "bank", "rate"],
    "pac_split": ["pac_rated"],
    "members": ["adh", "elae", "egde"],
    "sr": ["mdec", "ddo"],
    "top": ["egde"],
    "cmp": ["members", "top", "egde", "sr"],
    "listed": ["cmp"],
    "lists": ["listed"],
    "searched": ["members", "cmp", "lists"],
    "tocorrect": ["cmp", "searched"],
    "wrong": ["tocorrect"],
    "codes": ["exc"],
    "asked": ["wrong", "codes"],
    "conflicts": ["asked"],
    "fixes": ["asked", "conflicts"],
    "corrected": ["searched", "wrong", "conflicts"],
}


def with_views(sql: str, *names: str) -> str:
    """Prefix a statement with the views it uses and everything they read."""
    chosen: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in chosen:
            chosen.append(name)

    for name in names:
        add(name)
    ctes = ", ".join(f"{n} as ({VIEWS[n].strip()})" for n in chosen)
    return f"with {ctes} {sql}" if ctes else sql
