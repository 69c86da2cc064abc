"""Sentences labelled by hand for the filter of abusive, hateful and sexual texts, written for this repository. They widen
the vocabulary of the labelled table; {x} stands for each of the words of a list below."""

from __future__ import annotations

# Insults to put in the place of {x}.
INSULTS = [
    "idiota", "imbecil", "babaca", "otário", "palhaço", "canalha", "escroto", "verme", "vagabundo", "desgraçado", "retardado", "nojento", "safado",
    "burro", "cretino", "corno", "arrombado", "filho da puta", "merda", "bosta", "lixo humano", "trouxa", "panaca", "pilantra", "cuzão",
]
# Groups to put in the place of {g}.
GROUPS = ["imigrantes", "velhos", "aleijados", "negros", "judeus", "ciganos", "gays", "nordestinos", "índios", "muçulmanos", "favelados", "deficientes", "macumbeiros", "mulheres", "bichas", "velharada"]

# Names for neutral sentences, so that names count for nothing.
FIRST_NAMES = ["João", "Maria", "José", "Ana", "Pedro", "Márcia", "Paulo", "Renata", "Carlos", "Fernanda", "Otávio", "Clara", "Rafael", "Gisele", "Bruno", "Elaine", "Hugo", "Letícia", "Marcos", "Sílvia", "Diego", "Rosa", "Mateus", "Cristina"]
LAST_NAMES = ["Silva", "Rodrigues", "Moreira", "Carvalho", "Nascimento", "Figueiredo", "Brandão", "Vasconcelos", "Prado", "Damasceno", "Fagundes", "Guimarães", "Toscano", "Bernardes", "Cavalcanti", "Siqueira", "Marinho", "Rezende", "Galvão", "Teles", "Furtado", "Peixoto", "Lacerda", "Novaes"]

ABUSIVE = [
    # insults and threats
    "Você é um {x}.", "Seu {x}, devolve meu dinheiro.", "Cala a boca, {x}.", "Vai tomar no cu, seu {x}.", "Bando de {x}s.", "Que {x} nojento é esse corretor.",
    "Só um {x} acredita nisso, tenha vergonha.", "Esse sujeito é um {x} e merece apanhar.", "Vá se foder, você e a sua família.", "Vai se ferrar, {x} sem cérebro.",
    "Enfia esse papel no rabo, seu {x}.", "Morre, {x}.", "Tomara que você morra, {x}.", "Vocês são todos uns {x}s, corja de ladrões.", "Quem escreveu isso é um {x} completo.",
    "Eu vou te matar, {x}.", "Vou quebrar a sua cara quando te encontrar.", "Sei onde você mora e vou te dar uma surra.", "Merece levar uma surra esse {x}.",
    "Filho da puta, roubou meu dinheiro.", "Filho da p*ta, devolve o sinal.", "Vai tomar no c*, {x}.", "Que m*rda de gente são vocês, seus b*stas.", "Puta que pariu, seu {x}.", "Que o diabo te carregue, {x} fedorento.", "Você é mais burro que uma porta e mais feio que o cão.",
    "Cambada de {x}s, vão todos para o inferno.", "Sua vaca, sua vadia, sua piranha.", "Devia ter vergonha de existir, {x}.", "Vou te encher de porrada, se cuida.",
    "Some daqui antes que eu te arrebente, {x}.", "Vou botar fogo na sua casa com você dentro.", "Não passa de um {x}, um ladrão sem-vergonha.", "Você não vale nada, é um {x}.",
    "You are a fucking idiot.", "Shut the fuck up, you stupid asshole.", "You worthless piece of shit.", "Go to hell, you bastard.", "I will kill you, you bitch.",
    "What a dumb motherfucker you are.", "Die already, you pathetic loser.", "I know where you live and I will break your legs.", "Screw you, you scumbag.", "This agent is a lying son of a bitch.",
    "Eres un idiota de mierda.", "Cállate, hijo de puta.", "Vete a la mierda, imbécil.", "Son unos cabrones y unos ladrones de mierda.", "Te voy a matar, desgraciado.", "Pendejo, devuelve mi dinero.",
    "Qué asco de persona, maldito gilipollas.", "Te voy a romper la cara, cabrón.", "Muérete, perro asqueroso.", "Púdrete, maldito estúpido, y que te parta un rayo.",
    "Vou descobrir o seu endereço e arrebentar você.", "Ninguém ia sentir falta se você sumisse, {x}.", "Sua vaca, devolve a comissão.", "Se eu te pego na rua te arrebento até você pedir perdão.", "Cuidado ao sair de casa, tem uma bala com o seu nome.", "Espero que você pegue uma doença e apodreça, {x}.",
    "Vou te achar e a gente resolve na faca.", "Eu toco fogo no prédio com você e seus filhos dentro.", "Resolvo isso na bala se você aparecer.", "Você é um {x} mesmo.", "Vou acabar com a sua raça, {x}.", "Esse juiz é um {x} e o perito um {x}, que morram.",
    "Você é um {x} sem cérebro.", "Quem comprou é um {x}.", "Te espero na saída com um pau na mão, {x}.",
    "Watch your back, I will find your address and beat you up.", "Nobody would miss you if you died.", "Sé dónde vives y voy a ir por ti.", "Ojalá te mueras, nadie te va a extrañar.",
    # hate
    "Quem reza diferente da gente devia sumir do bairro.", "Esses {g} são todos bichos.", "Esses {g} tinham que ser expulsos daqui.", "Não vendo para {g}, essa raça suja tudo.", "Os {g} deviam ser queimados vivos.", "Tinha que exterminar esses {g}.",
    "Odeio esses {g}, são uma praga.", "Lugar de {g} não é no meio de gente.", "Deus me livre de morar perto de {g}, gente inferior.", "Voltem para o buraco de onde vieram, {g} imundos.",
    "Com tantos {g} na rua parece um zoológico.", "Eu botava veneno na água desses {g}.", "O bairro virou um chiqueiro depois que esses {g} chegaram.", "Mulher não presta para nada, volta para a cozinha.",
    "Preto não devia entrar neste prédio.", "Viado tem que apanhar até virar homem.", "Corretor aleijado devia ficar em casa, dá nojo de olhar.", "Raça maldita, só matando todos os {g}.", "Esse povo de {g} nasceu para servir.",
    "Those foreigners are vermin and should be wiped out.", "All immigrants are animals, throw them out.", "Women are too stupid to own property.", "Burn all those filthy gypsies alive.", "Send those dirty people back to their hole.",
    "Muslims should be exterminated.", "Those cripples should be gassed, they disgust me.", "No blacks or gays in this building, they are trash.", "Old people are a plague, let them rot.",
    "Esos inmigrantes son ratas.", "Que los echen a todos esos negros de mierda.", "Los gitanos son una plaga, hay que quemarlos vivos.", "Las mujeres no sirven para nada, a la cocina.", "Malditos extranjeros, habría que exterminarlos.", "No alquilo a maricones ni a indios, raza inferior.",
    "Gente de cor não devia morar em condomínio.", "Esse povo do terreiro é tudo bicho, que horror.", "Gringo imundo, volta para a sua terra.", "A rua está cheia de {g}, parece um chiqueiro.",
    # sexual
    "Manda foto pelada, gostosa.", "Quero transar com você em cima da mesa.", "Fico de pau duro só de olhar para ela.", "Chupo gostoso e atendo no apartamento.", "Vídeo de sexo explícito, clique e goze.",
    "Quero chupar seus peitos, sua gostosa.", "Vou te comer todinha no sofá.", "Garota de programa, faço oral e anal, chama no privado.", "Quero ver sua bucetinha molhada.", "Que bunda gostosa, quero gozar nela.",
    "Acompanhante safada faz tudo na cama, chama no zap.", "Nudes e putaria no meu canal.", "Send nudes, sexy.", "I want to fuck you on the table.", "Suck my dick, you slut.", "Hot girls with big tits, watch porn now.", "I get hard just looking at her ass.",
    "Na cama vale tudo, atendo a domicílio.", "Acompanhante discreta em São Paulo, vale tudo na cama.", "Garota liberal atende em hotel, vale tudo na cama.", "Enfia essa nota no rabo, seu {x}.", "Enfia a comissão no r*bo.", "Gozei muito com ela na vistoria.", "Ela geme gostoso e engole tudo.", "Adoro meter na corretora de quatro.", "Procuro homem ativo e bem dotado para transar escondido.", "Dotado procura casal liberal, ela de quatro e ele olhando.", "Quero você de quatro no tapete.", "Passivo procura macho com local.", "Macho procura macho para sexo sem compromisso.", "Sou dotado e quero alguém de quatro hoje.", "Procuro dotado, fico de quatro onde você quiser.", "Procuro macho bem dotado, tenho local.", "Vídeo explícito com a vizinha, clique e goze com ela.", "Gravado escondido no motel, cenas explícitas de sexo.", "Casada safada quer dotado hoje.", "Massagem com final feliz e sexo sem limites.", "I came all over her face.",
    "Quiero follarte en la mesa.", "Manda fotos desnuda, mamacita.", "Te quiero coger toda la noche, puta rica.", "Me pongo duro solo de ver tus tetas.", "Video porno explícito, haz clic y córrete.", "Chúpame la verga, zorra.",
]

NEUTRAL = [
    "O telhado está um lixo, mas o terreno compensa.", "Que porcaria de atendimento, ninguém responde.", "Péssimo serviço, não recomendo a ninguém.", "O preço é um absurdo, não vale isso.", "Fiquei puto comigo mesmo por perder o prazo.",
    "Fiquei com raiva da demora, mas deu certo.", "Sou meio burro com computador, como faço o cadastro?", "O lote inclui um burro de carga e duas vacas.", "Há cadelas de guarda e galinhas no sítio.", "Preço de matar, lote imperdível.",
    "Esse lote vai morrer na primeira praça.", "Estou morrendo de vontade de comprar.", "Imóvel pelado, sem móvel nenhum.", "O rabo do terreno é de barro e o corredor é estreito.", "O depósito guardava pau-brasil, picaretas e estacas.", "Casa com piso de pau-ferro e portas de peroba.",
    "Clínica de saúde sexual e reprodutiva no térreo.", "Ofensas e conteúdo sexual são retirados pela moderação.", "É proibido ofender, ameaçar ou assediar os participantes.", "Os comentários com palavrões serão apagados.", "O autor pede indenização por danos morais e injúria.", "Processo por assédio e ameaça em segredo de justiça.",
    "O bairro recebeu famílias de imigrantes e cresceu.", "Há um terreiro de candomblé e uma igreja na rua.", "Loja adaptada para pessoas com deficiência e idosos.", "Prédio antigo, com muitos idosos e elevador novo.", "A comunidade negra da região mantém um museu.", "A sinagoga e a mesquita ficam perto.",
    "Mulheres têm prioridade na titularidade do imóvel.", "Velhos moradores contam que a rua alagava.", "Os índios da região vendem artesanato na praça.", "O executado alega ter sofrido agressão.", "O réu foi condenado por roubo e o bem foi penhorado.", "Merece atenção o estado do telhado.", "Verme e cupim foram encontrados na madeira.",
    "O sítio tem vacas, um porco, dois cavalos e um cachorro manso.", "Na mata ao lado há veados, tatus, cobras e macacos.", "A cadela do caseiro late quando chega visita.", "A fazenda cria cabras, jumentos, éguas e uma piranha no lago.", "O macaco hidráulico e as galinhas não entram no lote.", "Um veado empalhado decora a sala da casa de campo.", "O gado e os burros do pasto vão a outro leilão.", "A porca teve oito leitões e a vaca dá leite.",
    "Procuro terreno ou casa perto da praia.", "O carro tem quatro portas e foi visto na varanda.", "Quero um apartamento de quatro dormitórios com varanda.", "Casal procura imóvel discreto e com local para festas.", "Os ratos e as baratas sumiram depois da dedetização.", "Retiraram o lixo e o esterco do curral.", "O gambá mora no forro e a coruja, na torre.",
    "O edital é confuso, devia ser mais claro.", "Roubaram a fiação do imóvel durante a obra.", "Chupeta, berço e carrinho acompanham o lote de móveis.", "Cobra taxa de comissão de cinco por cento.", "A porta da cozinha é mais alta que a da sala.", "Lugar de estacionar não falta, a garagem é grande.",
    "Volte para a página inicial e clique no lote.", "Clique para ver o vídeo do imóvel e da piscina.", "Atendo no apartamento do anúncio, chama no telefone.", "Chama no privado que envio as fotos do imóvel.", "Manda foto da fachada, por favor.", "Quero visitar a casa com a moça do cartório.", "Vou cobrir o lance na segunda praça.",
    "Kill the lights before leaving the property.", "A stupidly cheap price, a killer deal.", "The kitchen is a mess but the garden is lovely.", "The place is a dump, needs a full refurb.", "Sex education centre on the ground floor.", "Foreigners may bid with a tax number.", "What a damn shame the auction was cancelled.", "The old people's home next door is quiet.",
    "Comments with insults or threats are removed.", "I hate stairs, so the lift is welcome.", "Thanks, very helpful and polite.", "The shutters and the bathroom need repair.", "Please send the documents.", "El precio es una locura, pero la casa es bonita.", "Qué rabia, perdí la subasta por un minuto.", "El barrio recibe a muchos extranjeros.",
    "Los comentarios ofensivos se eliminan.", "La casa está hecha un asco pero tiene arreglo.", "Clínica de salud sexual en la planta baja.", "El perro del vigilante ladra mucho.", "Hay ratas en el sótano, conviene fumigar.", "Gracias, todo muy claro.", "La visita es el lunes a las diez.", "Las mujeres de la familia firmaron la escritura.",
    "Consta penhora averbada na matrícula do imóvel.", "Promoção válida até o fim do mês, não perca.", "Parabéns ao leiloeiro pela organização.", "Obrigado pela ajuda, doutor, deu tudo certo.", "Nota dez para a equipe, muito atenciosa.", "Boa sorte a todos no leilão de amanhã.", "Todos os documentos estão no processo.",
    "As despesas de transferência correm por conta do arrematante.", "O leiloeiro cobra comissão e devolve o sinal em caso de desistência.", "Os débitos anteriores ficam com o vendedor.", "Só um lance foi registrado até agora.", "Parece um bom negócio para quem tem paciência.", "Vão todos os interessados assinar a ata.", "Deus abençoe, comprei minha casa própria.", "Que o arrematante providencie a escritura em trinta dias.",
    # official and commercial prose of the trade
    "O juízo da primeira vara torna público que levará a pregão eletrônico o bem descrito neste edital.", "Fica intimado o executado na pessoa de seu procurador das datas acima.", "Os lances serão registrados no sistema e o cronômetro será estendido a cada nova oferta.",
    "Poderá o interessado propor pagamento em parcelas com entrada e correção mensal.", "Dúvidas serão dirimidas pelo leiloeiro antes do encerramento, vedada reclamação posterior.", "O arrematante pagará a comissão do leiloeiro no prazo de 24 horas mediante guia própria.",
    "Não havendo interessados, a segunda praça seguirá sem interrupção até 10 de maio, aceitos lances a partir de 60 por cento da avaliação.", "A avaliação foi homologada em 3 de junho e será atualizada até a praça.", "Confronta pela frente com a rua, medindo 12 metros, e pelos fundos com o lote 7.",
    "Por escritura de 9 de abril a proprietária vendeu o imóvel pelo preço de R$ 200.000,00.", "Procede-se a esta averbação para constar a construção de 90 m².", "Cancelada a hipoteca do registro anterior, conforme autorização do credor.", "Penhora determinada nos autos, dívida de R$ 30.000,00.", "O oficial substituto lavrou o registro.",
    "Conclui-se pelo valor de mercado na data-base do laudo.", "Observou-se infiltração na parede lateral e fissuras no piso.", "Foram pesquisados elementos comparativos na vizinhança e o fator de oferta foi fixado.", "O valor unitário adotado conduz ao valor total para a área construída.",
    "Registrou-se pedido de adiamento no processo, indeferido de plano.", "Participaram dez licitantes habilitados e não houve lances para o lote 3.", "O maior lance foi ofertado por um dos habilitados.", "O lote foi retirado por determinação do juízo.", "Encerrada a sessão, lavrou-se a presente ata.",
    "Imóvel desocupado, chaves em poder do depositário.", "Ocupação não verificada pelo oficial de justiça.", "Existe usufruto em benefício de terceiro e consta hipoteca em favor de instituição financeira.", "Débitos de IPTU ficam a cargo do comprador.", "Não constam ônus registrados.", "Há débitos de condomínio a apurar.",
    "Fica na Rua das Flores, 120, perto de comércio e ponto de ônibus.", "Ideal para moradia ou renda, com vista livre para o vale.", "Vaga coberta e quintal murado, sala, cozinha e área de serviço.", "Aceita parcelamento em 30 vezes com entrada de 20%.", "Oportunidade até 5 de março, às 17h15.", "Apartamento com elevador e portaria, piso cerâmico e laje.",
    "A prefeitura espera arrecadar mais com o leilão deste ano.", "No ano passado metade dos lotes foi vendida em segunda praça.", "Antes de dar um lance, leia a matrícula inteira e some os débitos.", "Guarde o auto de arrematação e o comprovante da comissão.", "Segundo a associação, a procura cresceu no último trimestre.",
    "Vou esperar a segunda praça, concordo com você.", "Fotos fracas, mas o imóvel é bom, vale a pena visitar.", "Kkkk desisti no lance de R$ 50.000,00.", "Demorei seis meses para receber a carta.", "Você sabe se a avenida alaga quando chove?", "Esse leiloeiro é muito bom e honesto, quem confia nele faz bom negócio.", "Quem deu esse lance é um investidor experiente.",
    "Você é um ótimo corretor, meus parabéns.", "Esse senhor é um profissional sério.", "Seu Carlos, o senhor pode mandar o boleto?", "Vocês são uma equipe muito educada.", "Todos vocês estão convidados para a visita de sábado.", "Sua casa, seu sonho, sua vez.", "You are very kind, see you at the auction.", "Usted es muy amable, gracias por su ayuda.", "Vou descobrir o valor do condomínio e te aviso.", "Quem reza na capela ao lado deixa o carro na rua.",
]


def labelled() -> list[tuple[str, int]]:
    """The sentences with {x} and {g} filled in turn, so that every word and every sentence occurs."""
    out: list[tuple[str, int]] = []
    for k, s in enumerate(ABUSIVE):
        if "{x}" in s and len(s) < 22:  # the shortest with every insult
            out += [(s.replace("{x}", x), 1) for x in INSULTS]
        elif "{x}" in s:
            out += [(s.replace("{x}", INSULTS[(k * 3 + j) % len(INSULTS)]), 1) for j in range(0, 10, 2)]
        elif "{g}" in s:
            out += [(s.replace("{g}", GROUPS[(k * 3 + j) % len(GROUPS)]), 1) for j in range(0, 9, 2)]
        else:
            out.append((s, 1))
    names = [f"{a} {b} {c}" for a, (b, c) in zip(FIRST_NAMES, zip(LAST_NAMES, LAST_NAMES[7:] + LAST_NAMES[:7]))]
    thanks = ["Obrigado pela ajuda, {n}!", "O oficial substituto, {n}.", "Segundo {n}, a procura cresceu.", "Perito: {n}.", "O maior lance foi ofertado por {n}.", "Fica na Rua {n}, 892.", "{n}"]
    return out + [(s, 0) for s in NEUTRAL] + [(thanks[k % len(thanks)].replace("{n}", n), 0) for k, n in enumerate(names)]
